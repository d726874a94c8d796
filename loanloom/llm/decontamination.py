"""Benchmark decontamination: a prefix-filtered set join of item windows with documents.

A window of an item is a set of word shingles, ordered by rarity in the corpus. A document contains the window only if
it has all of them, so the prefix that has to be joined is the rarest one. Where it occurs, the places of
the shingle in window and document fix where the window would start; starts outside the document fall to the
bounds, and the words of an item-sized window of the document are compared with the item's.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.shared import materialise

#: Bits of the map that tells which shingles can be in the benchmark, whatever the benchmark's size: 2 MB.
MAP_BITS = 1 << 24
#: Copies of each prefix row, so that the occurrences of a frequent passage meet it in as many groups.
SALTS = 16
#: Distinct shingles that a task counts before it passes them on.
HELD_SHINGLES = 200_000

_MULTIPLIER = np.uint64(6364136223846793005)
# Words are runs of 0-9, a-z and everything beyond ASCII, A-Z lowered.
_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 0x80 else 32 for b in range(256)
)


def split_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORDS).split()


def codes_of(words: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def shingles(codes: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of each run of ``width`` words."""
    n = len(codes) - width + 1
    out = np.full(max(n, 0), np.uint64(width))
    for k in range(width if n > 0 else 0):
        out = out * _MULTIPLIER + codes[k : k + n]
    return out ^ (out >> np.uint64(29))


# -- windows of the items ------------------------------------------------------------


def item_windows(items: DataFrame, window: int, shingle: int) -> DataFrame:
    """``item_id, words`` (one string), ``length, width`` and ``sets`` (the window's shingles in order), a row for each window.

    Items of fewer words than a window are one window; items without words have none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch["item_id"].to_pylist(), batch["text"]):
                words = split_words(text.as_py())
                length = min(window, len(words))
                if not length:
                    continue
                width = min(shingle, length)
                hashed, n = shingles(codes_of(words), width).view(np.int64), len(words) - length + 1
                own = length - width + 1
                for at in range(0, n, 4096):  # a huge item goes on in parts
                    part = range(at, min(n, at + 4096))
                    columns = [
                        pa.array([item] * len(part), pa.int64()),
                        pa.array([b" ".join(words[i : i + length]).decode() for i in part], pa.string()),
                        pa.array([length] * len(part), pa.int32()),
                        pa.array([width] * len(part), pa.int32()),
                        pa.array([hashed[i : i + own] for i in part], pa.list_(pa.int64())),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["item_id", "words", "length", "width", "sets"])

    return items.select(F.col("item_id").cast("long").alias("item_id"), "text").mapInArrow(
        run, "item_id long, words string, length int, width int, sets array<long>"
    )


def _bitmap(shingle_rows: DataFrame) -> np.ndarray:
    """A map of fixed size of the hashes in ``shingle``: a bit for each slot that one of them falls on."""
    slots = shingle_rows.select(F.pmod("shingle", F.lit(MAP_BITS)).alias("slot")).distinct()
    word = F.expr("slot div 64").alias("word")
    bits = slots.groupBy(word).agg(F.bit_or(F.expr("shiftleft(1L, cast(slot % 64 as int))")).alias("bits")).toArrow()
    out = np.zeros(MAP_BITS // 64, np.int64)
    out[bits["word"].to_numpy()] = bits["bits"].to_numpy()
    return out.view(np.uint64)


def _in_map(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    slot = hashes & np.uint64(MAP_BITS - 1)
    return (bitmap[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) != 0


# -- the corpus ---------------------------------------------------------------------


def corpus_counts(docs: DataFrame, known: DataFrame, widths: list[int]) -> DataFrame:
    """``shingle, n``: how often each shingle of ``known`` occurs in all texts."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(_bitmap(known))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[int] = Counter()

        def taken() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.int64()), pa.array(held.values(), pa.int64())], ["shingle", "n"])
            held.clear()
            return out

        for batch in batches:
            for text in batch["text"]:
                codes = codes_of(split_words(text.as_py()))
                for width in widths:
                    hashes = shingles(codes, width)
                    found, n = np.unique(hashes[_in_map(shared.value, hashes)].view(np.int64), return_counts=True)
                    for h, m in zip(found.tolist(), n.tolist()):
                        held[h] += m
                if len(held) >= HELD_SHINGLES:
                    yield taken()
        if held:
            yield taken()

    counted = docs.select("text").mapInArrow(run, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    return counted.join(known.select("shingle").distinct(), "shingle")


def rarest(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """``win, words, length, shingle, place``: the prefix of each distinct window, its rarest shingle and where it
    stands. Windows with a shingle that the corpus lacks are in no document and fall out."""
    tokens = windows.select("win", F.posexplode("sets").alias("place", "shingle"))
    ordered = tokens.join(counts, "shingle").groupBy("win").agg(
        F.min(F.struct("n", "shingle", "place")).alias("rare"), F.count("*").alias("met")
    )
    kept = windows.join(ordered, "win").filter(F.col("met") == F.size("sets"))
    return kept.select("win", "words", "length", F.col("rare.shingle").alias("shingle"), F.col("rare.place").alias("place"))


def occurrences(docs: DataFrame, prefixes: DataFrame, widths: list[int], window: int) -> DataFrame:
    """``row, doc_id, at, n_words, shingle, before, around``: where a prefix may occur in ``docs`` (``row, doc_id,
    text``).

    ``around`` holds the words from ``before`` words ahead of the place on, as many as any window can reach. Every
    document gives one row more, without a shingle, that has its id and number of words.
    """
    shared = docs.sparkSession.sparkContext.broadcast(_bitmap(prefixes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[] for _ in _FOUND]
            for row, doc_id, text in zip(batch["row"].to_pylist(), batch["doc_id"].to_pylist(), batch["text"]):
                words = split_words(text.as_py())
                codes, n = codes_of(words), len(words)
                rows = [(row, doc_id, None, n, None, None, None)]
                for width in widths:
                    hashes = shingles(codes, width)
                    for at in np.flatnonzero(_in_map(shared.value, hashes)).tolist():
                        first = max(0, at - window + width)
                        around = b" ".join(words[first : at + window]).decode()
                        rows.append((row, None, at, n, int(hashes[at].view(np.int64)), at - first, around))
                for column, values in zip(columns, zip(*rows)):
                    column += values
                if len(columns[0]) >= 4096:
                    yield _batch(columns)
                    columns = [[] for _ in _FOUND]
            yield _batch(columns)

    return docs.select("row", "doc_id", "text").mapInArrow(
        run, "row long, doc_id long, at long, n_words long, shingle long, before int, around string"
    )


_FOUND = pa.schema(
    [
        ("row", pa.int64()), ("doc_id", pa.int64()), ("at", pa.int64()), ("n_words", pa.int64()),
        ("shingle", pa.int64()), ("before", pa.int32()), ("around", pa.string()),
    ]
)


def _batch(columns: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _FOUND)], schema=_FOUND)


def _salted(rows: DataFrame, by: list[str]) -> DataFrame:
    return rows.withColumn("salt", F.pmod(F.xxhash64(*by), F.lit(SALTS)).cast("int"))


def _copied(rows: DataFrame) -> DataFrame:
    """Each row once per salt: its partners may be a third of all rows."""
    return rows.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def verified(found: DataFrame, prefixes: DataFrame) -> DataFrame:
    """``row, start, length, win``: the windows that really stand in a document, at every place."""
    start = F.col("at") - F.col("place")
    inside = (F.col("place") <= F.col("before")) & (start + F.col("length") <= F.col("n_words"))
    first = F.greatest(F.lit(1), F.col("before") - F.col("place") + 1)
    there = F.array_join(F.slice(F.split("around", " "), first, F.col("length")), " ")
    met = _salted(found, ["row", "at"]).join(_copied(prefixes), ["shingle", "salt"]).filter(inside)
    return met.filter(there == F.col("words")).select("row", start.alias("start"), "length", "win")


def covered_words(hits: DataFrame) -> DataFrame:
    """``row, n_hit``: the words of a document inside any of its hits (``row, start, length``), each once."""
    longest = hits.groupBy("row", "start").agg(F.max(F.col("start") + F.col("length")).alias("stop"))
    earlier = F.max("stop").over(Window.partitionBy("row").orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.greatest(F.lit(0).cast("long"), F.col("stop") - F.greatest(F.col("start"), F.coalesce("earlier", "start")))
    return longest.withColumn("earlier", earlier).groupBy("row").agg(F.sum(fresh).alias("n_hit"))


def contamination(docs: DataFrame, items: DataFrame, window: int = 10, shingle: int = 5) -> DataFrame:
    """``doc_id, n_words, n_hit, items`` (ids of the items that a document has windows of, sorted as strings) of every
    row of ``docs``.

    A window is ``window`` consecutive words of an item, or all of a shorter one. Words are runs of digits, letters
    and anything beyond ASCII, A-Z lowered. Null and empty texts have no words, and such items no windows; an
    item without an id hits words but is not listed; rows of one id stay apart, as documents and as items; an empty
    table gives an empty result, an empty benchmark no hits. Other columns are left out.

    Two passes over the texts, none of which is shuffled: the first counts the benchmark's shingles, the second
    finds the rarest of each window. What tasks know of the benchmark is a bit map of fixed size; candidates
    meet the windows in a salted join.
    """
    drawn = materialise(item_windows(items, window, shingle))
    widths = sorted(r["width"] for r in drawn.select("width").distinct().collect())  # at most ``shingle`` numbers
    distinct = drawn.groupBy("words", "length", "width").agg(F.first("sets").alias("sets"))
    windows = materialise(distinct.withColumn("win", F.monotonically_increasing_id()))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.monotonically_increasing_id().alias("row"))
    known = windows.select(F.explode("sets").alias("shingle"))
    prefixes = materialise(rarest(windows, materialise(corpus_counts(texts, known, widths))))
    found = materialise(occurrences(texts, prefixes, widths, window))
    hits = materialise(verified(found.filter("shingle IS NOT NULL"), prefixes))
    n_hit = covered_words(hits)
    owners = drawn.select("words", "item_id").distinct().join(windows.select("words", "win"), "words").select("win", "item_id")
    named = _salted(hits.select("row", "win").distinct(), ["row"]).join(_copied(materialise(owners)), ["win", "salt"])
    named = named.select("row", "item_id").distinct()
    listed = named.groupBy("row").agg(F.sort_array(F.collect_list(F.col("item_id").cast("string"))).alias("items"))
    return (
        found.filter("shingle IS NULL").select("row", "doc_id", "n_words").join(n_hit, "row", "left").join(listed, "row", "left")
        .select(
            "doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        )
    )
