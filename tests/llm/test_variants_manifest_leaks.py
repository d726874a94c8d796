"""Spelling variants, Merkle manifest and decontamination against brute force, and on awkward rows."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from loanloom.llm import decontamination, merkle, spelling
from .helpers import awkward_rows, clashing, prose, rows_of, table_of

ITEMS = "item_id long, text string"
A_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# -- spelling variants ----------------------------------------------------------------


def one_edit_apart(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(rows: list[tuple], rate: int = 97) -> list[tuple]:
    n = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(A_Z)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            n[run if h % rate else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    words = {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}
    near = {w: [v for v in words if abs(len(v) - len(w)) <= 1 and one_edit_apart(w, v)] for w in words}
    best = {w: min(near[w], key=lambda v: (-words[v], v)) for w in words if near[w]}
    form = {w: v if (v := best.get(w)) and words[v] >= 2 * words[w] else None for w in words}
    out = []
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), form[w] and words[form[w]]))
    return sorted(out, key=repr)


def scribbled(seed: int, n: int, alphabet: str = "abcdé") -> list[tuple]:
    draw = random.Random(seed)
    words = ["".join(draw.choice(alphabet) for _ in range(draw.randint(3, 8))) for _ in range(n)]
    rows = []
    for i in range(60):
        chosen = [draw.choice(words[: draw.randint(1, n)]) for _ in range(150)]
        rows.append((i, " ".join(w.upper() if draw.random() < 0.2 else w for w in chosen), "en", "a", 1))
    return rows


@pytest.mark.parametrize("cell_words", [4096, 1])
def test_variants_against_brute_force(spark, cell_words):
    rows = scribbled(1, 1200) + awkward_rows() + [(500 + i, "z" * 300 + " " + "z" * 301, "en", "a", 1) for i in range(3)]
    got = rows_of(spelling.spelling_variants(clashing(table_of(spark, rows)), rate=7, cell_words=cell_words))
    assert got == brute_variants(rows, 7) and any(r[1] for r in got) and any(r[1] != r[2] and r[1] for r in got)


def test_variants_of_nothing(spark):
    assert spelling.spelling_variants(table_of(spark, [])).count() == 0
    assert spelling.spelling_variants(table_of(spark, [(1, None, None, None, None), (2, "", "", "", 0)])).count() == 0


def test_cells_and_boxes_lose_no_pair():
    draw = random.Random(5)
    words = sorted({"".join(draw.choice("abcdeéz") for _ in range(n)) for _ in range(900) for n in (6, 7)})
    by_length = {n: [w for w in words if len(w) == n] for n in (6, 7)}
    groups = {n: spelling._words(by_length[n], n) for n in (6, 7)}
    for kind, visitors in ((True, 7), (False, 6)):
        got = Counter()
        for i, j in spelling.search(groups[7], groups[visitors], kind, leaf=8):
            got.update((by_length[visitors][a], by_length[7][b]) for a, b in zip(i, j))
        want = {
            (a, b) for a, b in itertools.product(by_length[visitors], by_length[7])
            if one_edit_apart(a, b) and (not kind or [x < y for x, y in zip(a, b) if x != y][0])
        }
        assert set(got) == want and set(got.values()) == {1}
        # The same through the splits on top: every pair's member lies in a cell that the visitor reaches.
        tree = spelling.Tree(np.array([0, 1, 25, 0]), np.array([0, 1, 0, 1]), np.arange(16), np.ones(16, np.int64))
        homes = dict(zip(by_length[7], tree.paths(groups[7].counts)))
        rows, cells = tree.reached(groups[visitors].counts, kind)
        reached = defaultdict(set)
        for r, c in zip(rows, cells):
            reached[by_length[visitors][r]].add(c)
        assert all(homes[b] in reached[a] for a, b in want)


# -- Merkle manifest --------------------------------------------------------------------


def h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_leaf(doc_id, text, lang, source, n_chars) -> str:
    spelled = []
    for v in (doc_id, source, lang, n_chars, text):
        spelled.append("-" if v is None else f"{len(str(v).encode())}:{v}")
    return h(*spelled)


def brute_tree(leaves: list[str], fan_out: int) -> tuple[str, list[list[tuple[str, str]]]]:
    """The root, and per leaf its siblings on each level."""
    paths, level, where = [[] for _ in leaves], leaves, list(range(len(leaves)))
    while len(level) > 1:
        for k, i in enumerate(where):
            start = i // fan_out * fan_out
            paths[k].append(("".join(level[start:i]), "".join(level[i + 1 : start + fan_out])))
        where = [i // fan_out for i in where]
        level = [h(*level[i : i + fan_out]) for i in range(0, len(level), fan_out)]
    return level[0], paths


def brute_manifest(rows: list[tuple], rate: int, fan_out: int) -> list[tuple]:
    sources = defaultdict(list)
    for row in rows:
        sources[row[3]].append(row)
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        sources[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, brute_leaf(*r)))
        trees[s] = brute_tree([brute_leaf(*r) for r in sources[s]], fan_out)
    root, crown = brute_tree([trees[s][0] for s in names], fan_out)
    out = []
    for k, s in enumerate(names):
        for row, own in zip(sources[s], trees[s][1]):
            path, found = own + crown[k], list(row)
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % rate == 0 and row[1] is not None:
                found[1] = row[1].translate(A_Z)
            folded = brute_leaf(*found)
            for left, right in path:
                folded = h(left, folded, right)
            proof = h(*(x for at in path for x in at))
            out.append((row[0], brute_leaf(*row), trees[s][0], root, proof, folded, folded == root))
    return sorted(out, key=repr)


@pytest.mark.parametrize("fan_out,n", [(16, 40), (3, 100), (2, 33)])
def test_manifest_against_brute_force(spark, fan_out, n):
    rows = awkward_rows() + [(100 + i, f"Text {i}", "en", ("hot", "hot", f"s{i}")[i % 3], i) for i in range(n)]
    rows += [(i, "No source", "en", None, None) for i in range(40, 45)] + [(90, "Ä", "de", "", 1), (91, "E", "de", "É", 1)]
    got = rows_of(merkle.manifest(clashing(table_of(spark, rows)), rate=2, fan_out=fan_out))
    assert got == brute_manifest(rows, 2, fan_out) and len({r[6] for r in got}) == 2


def test_manifest_of_one_row_and_of_none(spark):
    rows = [(1, "Alone", None, "a", None)]
    got = rows_of(merkle.manifest(table_of(spark, rows)))
    assert got == brute_manifest(rows, 5, 16) and got[0][1] == got[0][3] and got[0][4] == h("")
    assert merkle.manifest(table_of(spark, [])).count() == 0


def test_places_within_groups(spark):
    rows = [(("a", "b", "a", None)[i % 4] or "", i * 7 % 101) for i in range(101)]
    df = spark.createDataFrame(rows, "g string, x long").repartition(7)
    want = defaultdict(list)
    for g, x in sorted(rows):
        want[g].append(x)
    for r in merkle.place_within(df, "g", ["x"]).collect():
        assert want[r["g"]][r["place"]] == r["x"] and r["size"] == len(want[r["g"]])


# -- decontamination --------------------------------------------------------------------


def brute_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(A_Z))


def brute_contamination(rows: list[tuple], items: list[tuple], window: int = 10) -> list[tuple]:
    out = []
    for doc_id, text, *_ in rows:
        words, hit, listed = brute_words(text), set(), []
        for item, other in items:
            known, met = brute_words(other), False
            size = min(window, len(known))
            windows = {tuple(known[i : i + size]) for i in range(len(known) - size + 1)} if size else ()
            for i in range(len(words) - size + 1 if size else 0):
                if tuple(words[i : i + size]) in windows:
                    hit |= set(range(i, i + size))
                    met = True
            if met and item is not None:
                listed.append(str(item))
        out.append((doc_id, len(words), len(hit), sorted(listed)))
    return sorted(out, key=repr)


def benchmark_items() -> list[tuple]:
    return [
        (0, prose(30, 21)), (1, prose(12, 22)), (2, prose(10, 23)), (3, "Seven Little words, no more: été 7"), (4, "one"),
        (10, prose(30, 21)), (20, ""), (21, None), (22, " .,! "), (None, prose(14, 24)), (5, "a a a a a a a a a a a a a a"),
        (6, "two words"), (7, prose(11, 25)), (7, prose(15, 26)),
    ]


def test_contamination_against_brute_force(spark):
    items, draw = benchmark_items(), random.Random(6)
    rows = awkward_rows()
    for i in range(80):
        parts = []
        for _ in range(draw.randint(0, 5)):
            known = brute_words(draw.choice(items)[1]) or ["one"]
            at = draw.randint(0, len(known))
            parts += known[at : at + draw.randint(1, 14)] + prose(draw.randint(0, 4), i).split()
        text = " ".join(w.upper() if draw.random() < 0.3 else w for w in parts).replace(" ", ", ", 3)
        rows.append((100 + i, text, "en", "a", 1))
    rows += [(300, items[0][1].replace(" ", "\u0000-\n"), "en", "a", 1), (301, "a " * 40, "en", "a", 1)]
    docs, table = clashing(table_of(spark, rows)), clashing(spark.createDataFrame(items, ITEMS))
    got = rows_of(decontamination.contamination(docs, table))
    assert got == brute_contamination(rows, items) and sum(r[2] > 0 for r in got) > 20
    small = rows_of(decontamination.contamination(docs, table, window=4, shingle=2))
    assert small == brute_contamination(rows, items, 4)


def test_contamination_of_nothing(spark):
    docs, items = table_of(spark, awkward_rows()), spark.createDataFrame(benchmark_items(), ITEMS)
    assert decontamination.contamination(docs.limit(0), items).count() == 0
    clean = decontamination.contamination(docs, items.limit(0))
    assert rows_of(clean) == brute_contamination(awkward_rows(), [])
