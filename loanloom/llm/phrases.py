"""Substring deduplication by repeated-phrase automata.

A window of ``window`` words is removed where its word sequence also starts earlier. Phrases of ``phrase`` words are
drawn from every text by winnowing (the one of the least hash in each window), so that equal windows draw equal
phrases wherever they stand. A phrase is told by its pattern, a symbol of a small alphabet for each word. Patterns
that recur in other texts, or in their own, are confirmed by counting; each shard of documents compiles the ones of
its documents into an Aho-Corasick automaton and streams the documents through it, which tells where they stand.
Windows around the located phrases are the only ones that can recur; the first start of each is a minimum over
their digests, and every other start is removed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.shared import materialise

#: Characters of text whose documents share one automaton.
SHARD_CHARS = 4_000_000
#: What tells documents apart: the id, or the number of a row that has none.
KEY = ["unknown", "key"]

_MULTIPLIERS = (np.uint64(6364136223846793005), np.uint64(2862933555777941757))
_DIGEST = np.dtype([("one", np.int64), ("two", np.int64)])


class Sizes(NamedTuple):
    """Words of a window and of a phrase."""

    window: int = 20
    phrase: int = 8

    @property
    def bits(self) -> int:
        """Bits of a word's symbol: a pattern is one number. Two words may share a symbol; a phrase is then
        confirmed or located once too often, which no result depends on. Few symbols keep the automaton narrow."""
        return min(16, 64 // self.phrase)


def _rolled(codes: np.ndarray, width: int, multiplier: np.uint64) -> np.ndarray:
    """A 64-bit hash of each run of ``width`` codes, in wrapping arithmetic."""
    n = len(codes) - width + 1
    out = np.zeros(max(n, 0), np.uint64)
    for k in range(width if n > 0 else 0):
        out = out * multiplier + codes[k : k + n]
    return out ^ (out >> np.uint64(31))


class Text:
    """The words of a document and their hashes."""

    def __init__(self, text: str | None):
        import xxhash

        self.words = (text or "").encode("utf-8", "surrogatepass").split()
        self.codes = np.fromiter(map(xxhash.xxh3_64_intdigest, self.words), np.uint64, len(self.words))

    def identity(self) -> tuple[int, int]:
        """128 bits of the word sequence, as two signed numbers."""
        digest = hashlib.blake2b(self.codes.tobytes(), digest_size=16).digest()
        return tuple(int(x) for x in np.frombuffer(digest, "<i8"))

    def drawn(self, sizes: Sizes) -> np.ndarray:
        """The patterns of the drawn phrases, each as one number, in order."""
        grams = _rolled(self.codes, sizes.phrase, _MULTIPLIERS[0])
        reach = sizes.window - sizes.phrase + 1
        if len(grams) < reach:
            return np.empty(0, np.int64)
        least = np.lib.stride_tricks.sliding_window_view(grams, reach).argmin(axis=1)
        starts = np.unique(least + np.arange(len(least)))
        symbols, packed = self.codes >> np.uint64(64 - sizes.bits), np.zeros(len(starts), np.uint64)
        for k in range(sizes.phrase):
            packed = packed << np.uint64(sizes.bits) | symbols[starts + k]
        return packed.view(np.int64)

    def symbols(self, sizes: Sizes) -> str:
        """One character per word, from the upper bits of its hash."""
        return _characters(self.codes >> np.uint64(64 - sizes.bits))


def _characters(symbols: np.ndarray) -> str:
    return (symbols.astype(np.uint32) + np.uint32(0x10000)).tobytes().decode("utf-32-le")


def _patterns(packed: np.ndarray, sizes: Sizes) -> set[str]:
    """The strings of symbols that numbers made by ``drawn`` stand for."""
    shifts = np.arange(sizes.phrase - 1, -1, -1, dtype=np.uint64) * np.uint64(sizes.bits)
    symbols = (packed.view(np.uint64)[:, None] >> shifts) & np.uint64((1 << sizes.bits) - 1)
    every = _characters(symbols.ravel())
    return {every[i : i + sizes.phrase] for i in range(0, len(every), sizes.phrase)}


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    for batch in batches:
        shard, size = [], 0
        for k in range(batch.num_rows):
            row = {name: batch.column(i)[k] for i, name in enumerate(batch.schema.names)}
            row["text"] = row["text"].as_py()
            shard.append(row)
            size += len(row["text"] or "") + 64
            if size >= SHARD_CHARS:
                yield shard
                shard, size = [], 0
        if shard:
            yield shard


def _numbers(scalar: pa.ListScalar) -> np.ndarray:
    return scalar.values.to_numpy() if scalar.is_valid else np.empty(0, np.int64)


def _structs(scalar: pa.ListScalar) -> np.ndarray:
    """A list of digests as an array of them."""
    if not scalar.is_valid or not len(scalar):
        return np.empty(0, _DIGEST)
    out = np.empty(len(scalar), _DIGEST)
    for name in _DIGEST.names:
        out[name] = scalar.values.field(name).to_numpy()
    return out


def _alike(digests: np.ndarray) -> np.ndarray:
    """A number for each digest, the same for equal ones."""
    if not len(digests):
        return np.empty(0, np.int64)
    order = np.lexsort((digests["two"], digests["one"]))
    ordered = digests[order]
    new = (ordered["one"][1:] != ordered["one"][:-1]) | (ordered["two"][1:] != ordered["two"][:-1])
    out = np.empty(len(digests), np.int64)
    out[order] = np.concatenate(([0], np.cumsum(new)))
    return out


def _is_copy(row: dict, text: Text) -> bool:
    """Whether the whole document is one of its earlier copies, by identity."""
    copies = _structs(row["copies"])
    return len(copies) > 0 and text.identity() in {(int(a), int(b)) for a, b in copies}


def _locate(shard: list[dict], sizes: Sizes) -> Iterator[tuple[dict, Text, np.ndarray, np.ndarray]]:
    """Per document: the starts of the windows that hold one of its confirmed phrases, and the digests of each.

    A document counts the phrases it has drawn itself and no others that its shard knows, so the windows of a
    document are the same in whatever company it is streamed.
    """
    import ahocorasick

    automaton, texts = ahocorasick.Automaton(ahocorasick.STORE_LENGTH), []
    for row in shard:
        own = _patterns(_numbers(row["phrases"]), sizes)
        for pattern in own:
            automaton.add_word(pattern)
        texts.append((row, Text(row["text"]), own))
    if len(automaton):
        automaton.make_automaton()
    for row, text, own in texts:
        n = len(text.words) - sizes.window + 1
        if not own or n <= 0:
            yield row, text, np.empty(0, np.int64), np.empty(0, _DIGEST)
            continue
        symbols = text.symbols(sizes)
        found = (end for end, _ in automaton.iter(symbols) if symbols[end + 1 - sizes.phrase : end + 1] in own)
        ends = np.fromiter(found, np.int64)
        marks = np.zeros(n + 1, np.int64)
        np.add.at(marks, np.clip(ends + 1 - sizes.window, 0, n), 1)
        np.add.at(marks, np.clip(ends + 2 - sizes.phrase, 0, n), -1)
        at = np.flatnonzero(np.cumsum(marks[:n]) > 0)
        digests = np.empty(len(at), _DIGEST)
        for name, m in zip(_DIGEST.names, _MULTIPLIERS):
            digests[name] = _rolled(text.codes, sizes.window, m)[at].view(np.int64)
        yield row, text, at, digests


def _draw(docs: DataFrame, sizes: Sizes) -> DataFrame:
    """Per document its identity and distinct drawn phrases, with a mark on those drawn twice or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in _shards(batches):
            unknown, keys, ones, twos, phrases, often = [], [], [], [], [], []
            for row in shard:
                text = Text(row["text"])
                found, count = np.unique(text.drawn(sizes), return_counts=True)
                one, two = text.identity()
                unknown.append(row["unknown"].as_py())
                keys.append(row["key"].as_py())
                ones.append(one)
                twos.append(two)
                phrases.append(found)
                often.append(count > 1)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(unknown, pa.bool_()), pa.array(keys, pa.int64()), pa.array(ones, pa.int64()),
                    pa.array(twos, pa.int64()), pa.array(phrases, pa.list_(pa.int64())),
                    pa.array(often, pa.list_(pa.bool_())),
                ],
                [*KEY, "one", "two", "phrase", "often"],
            )

    schema = "unknown boolean, key long, one long, two long, phrase array<long>, often array<boolean>"
    return docs.select(*KEY, "text").mapInArrow(run, schema)


def confirmed_phrases(drawn: DataFrame) -> DataFrame:
    """``unknown, key, phrases, copies``: the recurring phrases of each document that is the first of its word
    sequence, and the identities under which a document is a copy of an earlier one.

    A phrase recurs if texts of different identity have it or one text has it twice, so that copies of a whole
    document confirm nothing. Minima, maxima and marks have partial sums; a phrase in every third document is one
    row for each task.
    """
    sequences = materialise(drawn.groupBy("one", "two").agg(*_least_key()).select("one", "two", *_first_key()))
    leads = (F.col("first_unknown") == F.col("unknown")) & (F.col("first") == F.col("key"))
    placed = materialise(
        drawn.select(*KEY, "one", "two")
        .join(sequences, ["one", "two"])
        .groupBy(*KEY)
        .agg(F.collect_set(F.when(~leads, F.struct("one", "two"))).alias("copies"), F.max(leads).alias("leads"))
    )
    exploded = drawn.select(*KEY, "one", F.inline(F.arrays_zip("phrase", "often")))
    recurring = materialise(
        exploded.groupBy("phrase")
        .agg(F.min("one").alias("low"), F.max("one").alias("high"), F.max("often").alias("often"))
        .filter("low <> high OR often")
        .select("phrase")
    )
    by_doc = exploded.select(*KEY, "phrase").join(recurring, "phrase")
    leading = by_doc.join(placed.filter("leads").select(*KEY), KEY, "left_semi")
    phrases = leading.groupBy(*KEY).agg(F.collect_set("phrase").alias("phrases"))
    return placed.select(*KEY, "copies").join(phrases, KEY, "left").filter("phrases IS NOT NULL OR size(copies) > 0")


def _least_key() -> list[Column]:
    """The least id, and the least number of the rows that have none."""
    return [F.min(F.when(~F.col("unknown"), F.col("key"))).alias("least_id"), F.min(F.when(F.col("unknown"), F.col("key"))).alias("least_row")]


def _first_key() -> list[Column]:
    return [F.col("least_id").isNull().alias("first_unknown"), F.coalesce("least_id", "least_row").alias("first")]


def _keyed(docs: DataFrame) -> DataFrame:
    """``unknown, key, doc_id, text``; rows without an id, if there are any, are stored with a number first."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    known = rows.select(F.lit(False).alias("unknown"), F.col("doc_id").alias("key"), "doc_id", "text").filter("doc_id IS NOT NULL")
    nameless = rows.filter("doc_id IS NULL")
    if nameless.isEmpty():
        return known
    return known.union(
        materialise(nameless.select(F.lit(True).alias("unknown"), F.monotonically_increasing_id().alias("key"), "doc_id", "text"))
    )


def deduplicate(docs: DataFrame, window: int = 20, phrase: int = 8) -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` (the words left, joined by spaces) of every row of ``docs``.

    A word goes if a window that covers it has a word sequence that starts earlier: in a smaller doc_id, or
    before in the same document. Windows are judged on the whole input. Documents of fewer words than a window
    keep everything. A null text has no words; rows without an id are documents of their own that come after all
    others, in the order in which they are stored; rows of one doc_id are one document (none is earlier than the
    other); an empty table gives an empty result.
    """
    sizes = Sizes(window, phrase)
    texts = _keyed(docs)
    drawn = materialise(_draw(texts, sizes))
    info = materialise(confirmed_phrases(drawn))
    joined = texts.join(info, KEY, "left")

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in _shards(batches):
            unknown, keys, found = [], [], []
            for row, text, at, digests in _locate(shard, sizes):
                if len(at) and not _is_copy(row, text):
                    found.append(digests[np.unique(_alike(digests), return_index=True)[1]])
                    keys.append(np.full(len(found[-1]), row["key"].as_py()))
                    unknown.append(np.full(len(found[-1]), row["unknown"].as_py()))
            if keys:
                every = np.concatenate(found)
                columns = [np.concatenate(unknown), np.concatenate(keys), every["one"].copy(), every["two"].copy()]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [*KEY, "one", "two"])

    # The same columns as below, so that both passes read one shuffle of the texts.
    found = joined.select(*KEY, "doc_id", "text", "phrases", "copies").mapInArrow(windows, "unknown boolean, key long, one long, two long")
    owned = found.groupBy("one", "two").agg(*_least_key()).select("one", "two", *_first_key())
    firsts = owned.groupBy(F.col("first_unknown").alias("unknown"), F.col("first").alias("key")).agg(
        F.collect_list(F.struct("one", "two")).alias("firsts")
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in _shards(batches):
            rows = []
            for row, text, at, digests in _locate(shard, sizes):
                n = len(text.words)
                gone = np.zeros(n, bool)
                if n >= window and _is_copy(row, text):
                    gone[:] = True
                elif len(at):
                    firsts = _structs(row["firsts"])
                    alike = _alike(np.concatenate((firsts, digests)))
                    own, here = alike[: len(firsts)], alike[len(firsts) :]
                    first = np.zeros(len(at), bool)
                    first[np.unique(here, return_index=True)[1]] = True
                    again = at[~(first & np.isin(here, own))]
                    marks = np.zeros(n + 1, np.int64)
                    marks[again] += 1
                    marks[again + window] -= 1
                    gone = np.cumsum(marks[:n]) > 0
                kept = b" ".join(w for w, g in zip(text.words, gone) if not g) if gone.any() else b" ".join(text.words)
                rows.append((row["doc_id"].as_py(), n, int(gone.sum()), kept.decode()))
            columns = list(zip(*rows))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "n_words", "n_removed", "kept"])

    located = joined.join(firsts, KEY, "left").select(*KEY, "doc_id", "text", "phrases", "copies", "firsts")
    return located.mapInArrow(cut, "doc_id long, n_words long, n_removed long, kept string")
