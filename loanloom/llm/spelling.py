"""Spelling variants: words one edit apart, found by k-d trees over letter-count vectors.

One edit moves at most one letter's count up by one and at most one down by one, an L1 distance of at most two.
The words of each length are dealt to the cells of a k-d tree whose splits ask "more than t of letter l?". A word
visits the cells that its box can reach: those of its own length for a replaced letter (one count up, one down) and
those of the next length for an inserted one (one count up). Inside a cell a k-d tree of its own prunes whole boxes
against all visitors at once; what is left is compared letter by letter.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.shared import materialise

#: Letters are a-z, then U+00C0 to U+00FF; A-Z count as a-z.
N_LETTERS = 26 + 64
#: Splits of a length's tree at most; what they leave too large is cut by hash.
MOST_SPLITS = 14
#: Distinct words that a task sums up before it passes them on.
HELD_WORDS = 200_000

_LETTER = np.zeros(256, np.uint8)
_LETTER[ord("a") : ord("z") + 1] = np.arange(26)
_LETTER[0xC0:0x100] = np.arange(26, N_LETTERS)
_RUNS = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256)
)  # Latin-1: A-Z lowered, all that is no letter a space


def misspelled(doc_id: int | None, run: bytes, rate: int) -> bytes:
    """A run of a document (Latin-1); if ``rate`` divides its check sum, it loses one letter."""
    utf8 = run if run.isascii() else run.decode("latin-1").encode()
    h = zlib.crc32(b"%b:%b" % (b"" if doc_id is None else b"%d" % doc_id, utf8))
    return run if h % rate else run[: (k := h % len(run))] + run[k + 1 :]


def _counted(rate: int, least_letters: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def taken() -> pa.RecordBatch:
            words = pa.array([w.decode("latin-1") for w in held], pa.string())
            counts = pa.array(held.values(), pa.int64())
            held.clear()
            return pa.RecordBatch.from_arrays([words, counts], ["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                runs = Counter((text.as_py() or "").encode("latin-1", "replace").translate(_RUNS).split())
                for own, n in runs.items():
                    if len(own) >= least_letters:
                        word = misspelled(doc_id, own, rate)
                        if len(word) >= least_letters:
                            held[word] += n
                if len(held) >= HELD_WORDS:
                    yield taken()
        if held:
            yield taken()

    return run


def vocabulary(docs: DataFrame, rate: int = 97, least_letters: int = 5, least_n: int = 3) -> DataFrame:
    """``word, n``: the words of all texts and how often they occur, rare and short ones left out.

    Words are runs of letters, A-Z lowered; of every ``rate``-th run of a document, by check sum, a letter is
    deleted. Tasks sum up what they read, so a frequent word is a few rows. A null text has no words, a null id
    counts as the empty one, repeated rows count again, an empty table has no words.
    """
    counted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _counted(rate, least_letters), "word string, n long"
    )
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_n)


# -- letter counts ------------------------------------------------------------------


class Words(NamedTuple):
    """Words of one length: letters (one row each), letter counts, and the parity of the counts in 64 bits."""

    letters: np.ndarray
    counts: np.ndarray
    parity: np.ndarray


def _letters(words: list[str], length: int) -> np.ndarray:
    return _LETTER[np.frombuffer("".join(words).encode("latin-1"), np.uint8)].reshape(len(words), length)


def _counts(letters: np.ndarray) -> np.ndarray:
    n, length = letters.shape
    out = np.empty((n, N_LETTERS), np.uint16 if length > 255 else np.uint8)
    for at in range(0, n, 16_384):
        part = letters[at : at + 16_384].astype(np.int64) + np.arange(min(16_384, n - at))[:, None] * N_LETTERS
        out[at : at + 16_384] = np.bincount(part.ravel(), minlength=len(part) * N_LETTERS).reshape(-1, N_LETTERS)
    return out


def _words(words: list[str], length: int) -> Words:
    letters = _letters(words, length)
    counts = _counts(letters)
    slots = np.uint64(1) << (np.arange(N_LETTERS, dtype=np.uint64) % np.uint64(64))
    parity = np.bitwise_xor.reduce(np.where(counts & 1, slots, np.uint64(0)), axis=1)
    return Words(letters, counts, parity)


def _of_lengths(words: list[str]) -> Iterator[tuple[int, np.ndarray]]:
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for length in np.unique(lengths):
        yield int(length), np.flatnonzero(lengths == length)


# -- the cells of each length -----------------------------------------------------


class Tree(NamedTuple):
    """The top of a length's k-d tree: its splits (letter, threshold) from the root down, one per level, and the
    cell of every path, the splits' answers being the bits of a number. Cells too large for the splits have parts."""

    letters: np.ndarray
    thresholds: np.ndarray
    cells: np.ndarray
    parts: np.ndarray

    def paths(self, counts: np.ndarray) -> np.ndarray:
        over = counts[:, self.letters] > self.thresholds
        return over @ (1 << np.arange(len(self.letters))) if len(self.letters) else np.zeros(len(counts), np.int64)

    def reached(self, counts: np.ndarray, downwards: bool) -> tuple[np.ndarray, np.ndarray]:
        """(word, cell) of all cells that a word reaches by one count more and, if ``downwards``, one count less."""
        path, own = self.paths(counts), counts[:, self.letters].astype(np.int64)
        up, down = own == self.thresholds, own == self.thresholds + 1
        every = np.arange(len(counts))
        rows, paths = [every], [path]
        for i in range(len(self.letters)):
            rows.append(at := np.flatnonzero(up[:, i]))
            paths.append(path[at] | (1 << i))
            for j in range(len(self.letters)) if downwards else ():
                if i == 0:
                    rows.append(at := np.flatnonzero(down[:, j]))
                    paths.append(path[at] & ~(1 << j))
                # A replaced letter is looked for from the word that has the smaller one.
                if self.letters[j] < self.letters[i]:
                    rows.append(at := np.flatnonzero(up[:, i] & down[:, j]))
                    paths.append(path[at] & ~(1 << j) | (1 << i))
        row, cell = np.concatenate(rows), self.cells[np.concatenate(paths)]
        seen = np.unique(row * len(self.parts) + cell)
        return seen // len(self.parts), seen % len(self.parts)


def _cell_rows(length: int, cell_words: int) -> int:
    """Words of a cell, fewer the longer they are."""
    return max(64, min(cell_words, 200_000 // length))


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per length, letter and threshold: words with more than so many of the letter."""
    for batch in batches:
        words, rows = batch["word"].to_pylist(), []
        for length, at in _of_lengths(words):
            counts = _counts(_letters([words[i] for i in at], length))
            for t in range(int(counts.max())):
                over = (counts > t).sum(axis=0)
                rows += [(length, int(k), t, int(over[k])) for k in np.flatnonzero(over)]
        columns = list(zip(*rows)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["length", "letter", "t", "n"])


def _split(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """The cell of each path, and the parts of each cell: a cell over the capacity is split by the next level."""
    levels = int(len(sizes)).bit_length() - 1
    cells, parts = np.zeros(len(sizes), np.int64), []
    open_cells, paths = [(0, 0)], np.arange(len(sizes))
    while open_cells:
        level, prefix = open_cells.pop()
        inside = paths & ((1 << level) - 1) == prefix
        n = int(sizes[inside].sum())
        if n > capacity and level < levels:
            open_cells += [(level + 1, prefix), (level + 1, prefix | 1 << level)]
        else:
            cells[inside] = len(parts)
            parts.append(max(1, -(-n // capacity)))
    return cells, np.array(parts)


def trees(vocabulary: DataFrame, cell_words: int = 4096) -> dict[int, Tree]:
    """The trees of all lengths that have more words than a cell.

    Splits are the most balanced questions of a length, by counts over all its words; how deep a branch goes is
    decided by the number of words on each path. What comes to the driver are these counts: at most
    ``N_LETTERS`` x ``length`` and 2^``MOST_SPLITS`` numbers for each length with over a cell's words.
    """
    sizes = {r["length"]: r["n"] for r in vocabulary.groupBy(F.length("word").alias("length")).agg(F.count("*").alias("n")).collect()}
    large = [k for k, n in sizes.items() if n > _cell_rows(k, cell_words)]
    if not large:
        return {}
    words = vocabulary.select("word").filter(F.length("word").isin(large))
    questions: dict[int, list[tuple[int, int, int]]] = {k: [] for k in large}
    for r in words.mapInArrow(_statistics, "length long, letter long, t long, n long").groupBy("length", "letter", "t").agg(F.sum("n").alias("n")).collect():
        questions[r["length"]].append((abs(2 * r["n"] - sizes[r["length"]]), r["letter"], r["t"]))
    asked = {}
    for k in large:
        best = sorted(questions[k])[:MOST_SPLITS]
        asked[k] = Tree(np.array([q[1] for q in best]), np.array([q[2] for q in best]), np.zeros(0, np.int64), np.zeros(0, np.int64))

    def paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch["word"].to_pylist()
            for length, at in _of_lengths(words):
                found, n = np.unique(asked[length].paths(_counts(_letters([words[i] for i in at], length))), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), length)), pa.array(found), pa.array(n)], ["length", "path", "n"])

    on_path = {k: np.zeros(1 << len(asked[k].letters), np.int64) for k in large}
    for r in words.mapInArrow(paths, "length long, path long, n long").groupBy("length", "path").agg(F.sum("n").alias("n")).collect():
        on_path[r["length"]][r["path"]] = r["n"]
    out = {}
    for k in large:
        cells, parts = _split(on_path[k], _cell_rows(k, cell_words))
        out[k] = asked[k]._replace(cells=cells, parts=parts)
    return out


_ALONE = Tree(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(1, np.int64), np.ones(1, np.int64))
_DEALT = "length long, cell long, part long, kind int, word string, n long"


def _deal(forest: dict[int, Tree]):
    """Rows of every cell: its members (kind 0), visitors of its length (1) and shorter ones (2)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, n = batch["word"].to_pylist(), batch["n"].to_numpy()
            for length, at in _of_lengths(words):
                own = [words[i] for i in at]
                counts = _counts(_letters(own, length))
                tree, longer = forest.get(length, _ALONE), forest.get(length + 1, _ALONE)
                home = tree.cells[tree.paths(counts)]
                spread = np.fromiter((zlib.crc32(w.encode()) for w in own), np.int64, len(own))
                dealt = [(length, np.arange(len(own)), home, spread % tree.parts[home], 0)]
                for kind, to, other in ((1, length, tree), (2, length + 1, longer)):
                    rows, cells = other.reached(counts, kind == 1)
                    copies = other.parts[cells]
                    part = np.arange(copies.sum()) - np.repeat(np.cumsum(copies) - copies, copies)
                    dealt.append((to, np.repeat(rows, copies), np.repeat(cells, copies), part, kind))
                for to, rows, cells, part, kind in dealt:
                    m = len(rows)
                    columns = [
                        pa.array(np.full(m, to)), pa.array(cells), pa.array(part), pa.array(np.full(m, kind, np.int32)),
                        pa.array(np.array(own, object)[rows], pa.string()), pa.array(n[at][rows], pa.int64()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["length", "cell", "part", "kind", "word", "n"])

    return run


# -- range searches inside a cell ---------------------------------------------------


def _replaced(visitor: np.ndarray, member: np.ndarray) -> np.ndarray:
    """One letter differs, and the member has the greater one: each pair is found from one side."""
    apart = visitor != member
    return (apart.sum(axis=1) == 1) & (np.where(apart, member.astype(np.int16) - visitor, 0).sum(axis=1) > 0)


def _inserted(visitor: np.ndarray, member: np.ndarray) -> np.ndarray:
    """The member is the visitor with one more letter: equal up to a place, equal behind it."""
    ahead = np.logical_and.accumulate(visitor == member[:, :-1], axis=1).sum(axis=1)
    behind = np.logical_and.accumulate((visitor == member[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return ahead + behind >= visitor.shape[1]


def search(members: Words, visitors: Words, downwards: bool, leaf: int = 128) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(visitor, member) pairs one edit apart: a replaced letter if ``downwards``, else one more in the member.

    The members are split at the most balanced question, again and again. A visitor goes on into a box if it needs
    no more than one count up, and one down, to lie in it.
    """
    verify = _replaced if downwards else _inserted
    most_down = 1 if downwards else 0
    n_members, n_visitors = len(members.parity), len(visitors.parity)
    start = np.zeros(n_visitors, np.int8)
    stack = [(np.arange(n_members), np.arange(n_visitors), start, start, {})]
    while stack:
        inside, seekers, up, down, box = stack.pop()
        if not len(seekers):
            continue
        question = _question(members.counts[inside]) if len(inside) > leaf else None
        if question is None:
            for at in range(0, len(seekers), 1 + 500_000 // len(inside)):
                part = seekers[at : at + 1 + 500_000 // len(inside)]
                apart = np.bitwise_count(visitors.parity[part][:, None] ^ members.parity[inside][None, :])
                i, j = np.nonzero(apart <= 1 + most_down)
                i, j = part[i], inside[j]
                right = verify(visitors.letters[i], members.letters[j])
                yield i[right], j[right]
            continue
        letter, t = question
        low, high = box.get(letter, (0, 1 << 30))
        has, own = members.counts[inside, letter] > t, visitors.counts[seekers, letter].astype(np.int64)
        for over, (lo, hi) in ((True, (t + 1, high)), (False, (low, t))):
            more = up + np.maximum(lo - own, 0) - np.maximum(low - own, 0)
            less = down + np.maximum(own - hi, 0) - np.maximum(own - high, 0)
            on = (more <= 1) & (less <= most_down)
            stack.append((inside[has == over], seekers[on], more[on], less[on], {**box, letter: (lo, hi)}))


def _question(counts: np.ndarray) -> tuple[int, int] | None:
    """The letter and threshold that halve the rows best; None if all are alike."""
    best = None
    for t in range(int(counts.max())):
        over = (counts > t).sum(axis=0)
        k = int(np.abs(2 * over - len(counts)).argmin())
        if 0 < over[k] < len(counts) and (best is None or abs(2 * over[k] - len(counts)) < best[0]):
            best = abs(2 * int(over[k]) - len(counts)), k, t
        elif not over.any():
            break
    return best and best[1:]


def _found_in_cell(table: pa.Table) -> pa.Table:
    """Per word of a cell: how many near words the cell has shown it, and the most frequent of them."""
    length = table["length"][0].as_py()
    kind, n, words = table["kind"].to_numpy(), table["n"].to_numpy(), table["word"].to_pylist()
    found_a, found_b = [], []
    home = np.flatnonzero(kind == 0)
    if len(home):
        members = _words([words[i] for i in home], length)
        for k in (1, 2):
            guests = np.flatnonzero(kind == k)
            if len(guests):
                visitors = _words([words[i] for i in guests], length - (k == 2))
                for i, j in search(members, visitors, k == 1):
                    found_a += [guests[i], home[j]]
                    found_b += [home[j], guests[i]]
    a, b = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (found_a, found_b))
    by_word = sorted(range(len(words)), key=lambda i: (-n[i], words[i]))
    place = np.empty(len(words), np.int64)
    place[by_word] = np.arange(len(words))
    best, near = np.full(len(words), len(words)), np.bincount(a, minlength=len(words))
    np.minimum.at(best, a, place[b])
    rows = np.flatnonzero(near)
    forms = [by_word[k] for k in best[rows]]
    return pa.table(
        {
            "word": pa.array([words[i] for i in rows], pa.string()),
            "n_near": pa.array(near[rows], pa.int64()),
            "n": pa.array(n[forms], pa.int64()),
            "form": pa.array([words[i] for i in forms], pa.string()),
        }
    )


# -- variants -------------------------------------------------------------------------


def near_words(words: DataFrame, cell_words: int = 4096) -> DataFrame:
    """``word, n_near, form, form_n``: the number of words one edit apart and the most frequent of them (ties: the
    smallest in code-point order), for the rows of ``words`` (``word``, distinct, of at least two letters; ``n``)
    that have any.

    A cell gives one row for each word that it has seen, not its pairs. Words and visitors of a cell are bounded by
    ``cell_words`` and the cells that one edit reaches.
    """
    dealt = words.select("word", "n").mapInArrow(_deal(trees(words, cell_words)), _DEALT)
    seen = dealt.groupBy("length", "cell", "part").applyInArrow(_found_in_cell, "word string, n_near long, n long, form string")
    best = F.min(F.struct((-F.col("n")).alias("minus_n"), "form"))
    return (
        seen.groupBy("word")
        .agg(F.sum("n_near").alias("n_near"), best.alias("best"))
        .select("word", "n_near", F.col("best.form").alias("form"), (-F.col("best.minus_n")).alias("form_n"))
    )


def follow(forms: DataFrame, hops: int) -> DataFrame:
    """``word, root``: the last word reached from ``forms`` (``word, form``, one row per word, no circles), for at
    least ``hops`` steps. Each round doubles the steps taken."""
    ahead, taken = materialise(forms.select("word", F.col("form").alias("root"))), 1
    while taken < hops:
        further = ahead.select(F.col("word").alias("root"), F.col("root").alias("later"))
        ahead = materialise(ahead.join(further, "root", "left").select("word", F.coalesce("later", "root").alias("root")))
        taken *= 2
    return ahead


def spelling_variants(docs: DataFrame, rate: int = 97, least_letters: int = 5, least_n: int = 3, cell_words: int = 4096) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of ``docs``.

    ``form`` is the most frequent near word if it occurs at least twice as often as the word, else null (and
    ``form_n`` with it); ``root`` is where forms lead in the end, the word itself without one. Each step at least
    doubles the count, which bounds the steps. Null texts have no words, a null id counts as the empty one, rows of
    one id count each, ties go to the smallest word, an empty table gives an empty result, other columns are left
    out. ``least_letters`` is two or more.
    """
    words = materialise(vocabulary(docs, rate, least_letters, least_n))
    near = near_words(words, cell_words)
    is_form = F.col("form_n") >= 2 * F.col("n")
    judged = materialise(
        words.join(near, "word", "left").select(
            "word", F.when(is_form, F.col("form")).alias("form"), "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("form_n")).alias("form_n"),
        )
    )
    most = judged.agg(F.max("form_n")).first()[0] or 0
    hops = max(1, (most // max(1, least_n)).bit_length())
    roots = follow(judged.filter("form IS NOT NULL"), hops)
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
