"""SimHash, embeddings, components and repeated phrases against brute force, and on awkward rows."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from loanloom.llm import embedding_join, phrases, simhash
from loanloom.llm.components import components, join_local
from .helpers import awkward_rows, clashing, prose, rows_of, table_of


def least_reachable(n: int, links: set[tuple[int, int]]) -> list[int]:
    label = list(range(n))
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


@pytest.mark.parametrize("shape", ["chain", "star", "random", "empty"])
def test_components(spark, shape):
    draw = random.Random(1)
    n = 60
    links = {
        "chain": {(i, i + 1) for i in range(n - 1)},
        "star": {(0, i) for i in range(1, n)} | {(7, 7)},
        "random": {(draw.randrange(n), draw.randrange(n)) for _ in range(40)},
        "empty": set(),
    }[shape]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(list(links) + [(None, 3)], "a long, b long")).collect()}
    want = least_reachable(n, links)
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert set(found) == linked
    groups = {}
    for node, root in found.items():
        assert want[root] == want[node] and groups.setdefault(want[node], root) == root
    left, right = np.array([a for a, _ in links], int), np.array([b for _, b in links], int)
    assert join_local(left, right, n).tolist() == want


def brute_fingerprint(text: str | None) -> int:
    import xxhash

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_and_components(spark):
    near = [(200 + i, prose(80, 1) + f" tail{i}", "en", "a", 1) for i in range(30)]
    rows = awkward_rows() + near + [(300 + i, prose(20, 40 + i), "en", "a", 1) for i in range(60)]
    got = rows_of(simhash.near_duplicates(clashing(table_of(spark, rows)), tile_rows=7))
    codes = [brute_fingerprint(r[1]) for r in rows]
    links = {(i, j) for i in range(len(rows)) for j in range(i) if (codes[i] ^ codes[j]).bit_count() <= 3}
    label = least_reachable(len(rows), links)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[label[i]] = min(least.get(label[i], r[0]), r[0])
    want = [(r[0], f"{codes[i]:016x}", least.get(label[i])) for i, r in enumerate(rows)]
    assert got == sorted(want, key=repr)
    assert len(links) > 50
    kept = simhash.one_of_each(clashing(table_of(spark, rows)))
    assert {r["doc_id"] for r in kept.select("doc_id").collect()} == set(least.values())
    assert simhash.near_duplicates(table_of(spark, [])).count() == 0


def test_tiles_in_blocks_equal_all_pairs():
    draw = np.random.default_rng(3)
    a = draw.integers(0, 1 << 63, 2500, dtype=np.uint64)
    b = np.concatenate((a[:400] ^ np.uint64(9), draw.integers(0, 1 << 63, 1800, dtype=np.uint64)))
    x, y = simhash._near(a, b, 3, False)
    assert set(zip(x.tolist(), y.tolist())) == {
        (int(i), int(j) + len(a)) for i, j in zip(*np.nonzero(np.bitwise_count(a[:, None] ^ b[None, :]) <= 3))
    }


def vectors() -> list[tuple]:
    draw = np.random.default_rng(5)
    centre = draw.normal(size=(6, 16))
    rows = [(i, (centre[i % 6] + 0.12 * draw.normal(size=16)).astype("float32").tolist(), i % 3) for i in range(150)]
    rows += [(200 + i, draw.normal(size=16).astype("float32").tolist(), 0) for i in range(60)]
    rows += [(300 + i, rows[0][1], 1) for i in range(40)]  # copies
    odd = [None, [0.0] * 16, [float("nan")] + [1.0] * 15, [None] + [1.0] * 15, [float("inf")] * 16, [], [1.0, 2.0]]
    rows += [(400 + i, v, None) for i, v in enumerate(odd)]
    return rows + [(500, [x * 1e30 for x in rows[1][1]], 0), (None, rows[0][1], 0), (300, rows[0][1], 1)]


@pytest.mark.parametrize("interval", [16, 4096])
def test_embedding_join_against_all_pairs(spark, interval):
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = rows_of(embedding_join.near_vectors(df, interval_rows=interval))
    unit = [
        np.array(v, float) / np.linalg.norm(np.array(v, float))
        if v is not None and len(v) == 16 and None not in v and np.isfinite(np.array(v, float)).all() and any(v)
        else None
        for _, v, _ in rows
    ]
    links = {
        (i, j) for i in range(len(rows)) for j in range(i)
        if unit[i] is not None and unit[j] is not None and unit[i] @ unit[j] >= 0.9
    }
    label = least_reachable(len(rows), links)
    count = Counter(x for link in links for x in link)
    least: dict[int, int] = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[label[i]] = min(least.get(label[i], r[0]), r[0])
    want = [(r[0], count[i], least.get(label[i]), r[0] is not None and r[0] == least.get(label[i])) for i, r in enumerate(rows)]
    assert got == sorted(want, key=repr)
    assert embedding_join.near_vectors(df.limit(0)).count() == 0


def brute_cut(rows: list[tuple]) -> list[tuple]:
    last = 1 << 63
    words = [(r[1] or "").encode().split() for r in rows]
    first: dict[tuple, tuple] = {}
    for r, w in zip(rows, words):
        for s in range(len(w) - 19):
            at = (last if r[0] is None else r[0], s)
            key = tuple(w[s : s + 20])
            first[key] = min(first.get(key, at), at)
    out = []
    for r, w in zip(rows, words):
        gone = set()
        for s in range(len(w) - 19):
            if first[tuple(w[s : s + 20])] < (last if r[0] is None else r[0], s):
                gone |= set(range(s, s + 20))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((r[0], len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def test_repeated_phrases_against_brute_force(spark):
    draw = random.Random(9)
    passage = [prose(n, 70 + n) for n in (20, 21, 33, 90)]
    rows = awkward_rows()
    for i in range(80):
        parts = [prose(draw.randint(0, 60), 500 + i), draw.choice(passage), prose(draw.randint(0, 30), 900 + i % 20)]
        if i % 5 == 0:
            parts.append(parts[1])
        rows.append((100 + i, " ".join(parts), "en", "a", 1))
    rows += [(300 + i, "a b " * draw.randint(1, 60), "en", "a", 1) for i in range(12)]
    rows += [(400 + i, rows[20][1], "en", "a", 1) for i in range(10)]
    got = phrases.deduplicate(clashing(table_of(spark, rows)))
    assert rows_of(got.withColumn("kept", F.sha2("kept", 256))) == brute_cut(rows)
    assert phrases.deduplicate(table_of(spark, [])).count() == 0


def test_rows_without_id_are_documents_of_their_own(spark):
    texts = [prose(50, 800 + k) for k in range(5)]
    rows = [(None, texts[k % 5], "en", "a", 1) for k in range(100)] + [(7, texts[0] + " " + prose(30, 850), "en", "a", 1)]
    got = phrases.deduplicate(table_of(spark, rows).repartition(4)).collect()
    whole = [r for r in got if r["doc_id"] is None and r["n_removed"] == 0]
    assert sorted(r["kept"] for r in whole) == sorted(texts[1:])  # the first one stands in a document with an id
    assert all(r["n_removed"] in (0, 50) for r in got) and sum(r["n_removed"] for r in got) == 96 * 50


@pytest.mark.parametrize("phrase", [3, 8, 13])
def test_patterns_are_what_the_automaton_reads(phrase):
    sizes = phrases.Sizes(20, phrase)
    text = phrases.Text(prose(300, 31))
    drawn, symbols = text.drawn(sizes), text.symbols(sizes)
    own = phrases._patterns(np.unique(drawn), sizes)
    assert len(symbols) == 300 and len(own) == len(set(drawn.tolist())) and all(p in symbols for p in own)
    reach = 20 - phrase + 1
    assert all(any(symbols[i + k : i + k + phrase] in own for k in range(reach)) for i in range(300 - 20 + 1))


def test_one_row_of_each_group_stays_whatever_its_id(spark):
    texts = [prose(60, 500 + k) for k in range(4)]
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[1]), (7, texts[2]), (7, texts[2]), (9, texts[2]), (None, texts[3]), (3, texts[3])]
    docs = table_of(spark, [(i, t, "en", "a", k) for k, (i, t) in enumerate(rows)])
    kept = simhash.one_of_each(docs.repartition(3))
    assert kept.columns == docs.columns
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr)
    assert got == sorted([(None, texts[0]), (None, texts[1]), (7, texts[2]), (3, texts[3])], key=repr)


def test_vectors_with_columns_of_clashing_names(spark):
    draw = np.random.default_rng(3)
    vectors = draw.normal(size=(40, 8)).astype(float)
    vectors[20:] = vectors[:20] + 0.01 * draw.normal(size=(20, 8))
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)] + [(50, None), (51, []), (None, vectors[0].tolist())]
    plain = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    clash = clashing(plain)
    for name in ("a", "b", "other", "cell", "least", "n_links", "component_id", "kept", "label"):
        clash = clash.selectExpr("*", f"'clash' AS {name}")
    assert rows_of(embedding_join.near_vectors(clash)) == rows_of(embedding_join.near_vectors(plain))
