"""SimHash near-duplicates: tiles of fingerprints compared exactly by exclusive-or and bit counts."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.shared import materialise
from .components import components, join_local

BITS = 64


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """A bit is 1 if it is set in over half the hashes of the text's word shingles, repeats included.

    Fewer words than a shingle are one shingle; a text without words has the fingerprint zero.
    """
    import xxhash

    # bytes.lower and bytes.split know just A-Z and just the six ASCII separators.
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)
    shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(seed)), np.uint64, len(words) - shingle + 1)
    ones = np.zeros(BITS, np.int64)
    for part in range(0, len(hashes), 65_536):  # eight times as many bytes are unpacked at once
        bits = np.unpackbits(hashes[part : part + 65_536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    majority = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(majority.view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42) -> DataFrame:
    """``doc_id, code`` of every row; ``code`` holds the 64 bits as a signed number."""

    @F.pandas_udf("long")
    def code(texts: pd.Series) -> pd.Series:
        found = [fingerprint(x if isinstance(x, str) else None, shingle, seed) for x in texts]
        return pd.Series(np.array(found, np.uint64).view(np.int64))

    return docs.select("doc_id", code("text").alias("code"))


def _near(a: np.ndarray, b: np.ndarray, radius: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Local nodes (rows of ``a``, then rows of ``b``) that lie within the radius of each other.

    Rows are grouped by the bit counts of their quarters; a group meets only those groups whose counts differ by
    the radius or less in all, since every differing bit moves one count by one at most.
    """

    def blocks(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        counts = np.stack([np.bitwise_count((x >> np.uint64(s)) & np.uint64(0xFFFF)) for s in (0, 16, 32, 48)], 1)
        key = counts.astype(np.int64) @ np.array([1, 32, 1024, 32_768])
        order = np.argsort(key, kind="stable")
        found, first = np.unique(key[order], return_index=True)
        parts = np.stack([(found >> s) & 31 for s in (0, 5, 10, 15)], 1)
        return order, np.append(first, len(x)), parts

    lefts, rights = [], []
    if len(a) * len(b) <= 4_000_000:
        pieces = [(np.arange(len(a)), np.arange(len(b)))]
    else:
        order_a, edge_a, parts_a = blocks(a)
        order_b, edge_b, parts_b = blocks(b)
        pieces = []
        for i, part in enumerate(parts_a):
            reach = np.flatnonzero(np.abs(parts_b - part).sum(axis=1) <= radius)
            if len(reach):
                rows = np.concatenate([order_b[edge_b[j] : edge_b[j + 1]] for j in reach])
                pieces.append((order_a[edge_a[i] : edge_a[i + 1]], rows))
    for rows_a, rows_b in pieces:
        for at in range(0, len(rows_a), max(1, 1_000_000 // max(1, len(rows_b)))):
            part = rows_a[at : at + max(1, 1_000_000 // max(1, len(rows_b)))]
            i, j = np.nonzero(np.bitwise_count(a[part][:, None] ^ b[rows_b][None, :]) <= radius)
            lefts.append(part[i])
            rights.append(rows_b[j] if same else rows_b[j] + len(a))
            if sum(map(len, lefts)) > 1_000_000:  # a crowd of near copies: a spanning tree says as much
                x, y = np.concatenate(lefts), np.concatenate(rights)
                label = join_local(x, y, len(a) + (0 if same else len(b)))
                moved = np.flatnonzero(label != np.arange(len(label)))
                lefts, rights = [moved], [label[moved]]
    if not lefts:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(lefts), np.concatenate(rights)


def link_codes(codes: DataFrame, radius: int = 3, tile_rows: int = 65_536) -> DataFrame:
    """Links ``a, b`` that join all distinct ``code`` values within ``radius`` bits of each other.

    Codes are dealt to classes by the bit counts of their two halves and classes to tiles of about ``tile_rows``;
    only tiles whose counts differ by the radius or less in all are compared, every pair of rows exactly. A pair
    of tiles gives a spanning tree of its links, so a crowd of near copies doesn't give all its pairs. A tile is
    copied once per tile it meets, so large ones (half a megabyte) shuffle less; inside, quarters prune again.
    """
    half = [F.bit_count(F.expr(f"(code >> {s}) & 4294967295")).alias(c) for s, c in ((0, "low"), (32, "high"))]
    rows = codes.select("code", *half)
    classes = materialise(
        rows.groupBy("low", "high").agg(F.ceil(F.count("*") / tile_rows).cast("int").alias("splits"))
    )  # at most 33 x 33 rows
    tile = F.pmod(F.xxhash64("code"), F.col("splits")).cast("int")
    tiles = materialise(
        rows.join(F.broadcast(classes), ["low", "high"])
        .groupBy("low", "high", tile.alias("split"))
        .agg(F.collect_list("code").alias("codes"))
    )
    steps = [(x, y) for x in range(-radius, radius + 1) for y in range(-radius, radius + 1) if abs(x) + abs(y) <= radius]
    steps = [s for s in steps if s >= (0, 0)]  # each pair of classes once
    keys = tiles.select("low", "high", "split")
    near = keys.withColumn("step", F.explode(F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in steps])))
    near = near.select("low", "high", "split", (F.col("low") + F.col("step.x")).alias("low_b"), (F.col("high") + F.col("step.y")).alias("high_b"))
    other = classes.select(F.col("low").alias("low_b"), F.col("high").alias("high_b"), F.col("splits"))
    pairs = (
        near.join(F.broadcast(other), ["low_b", "high_b"])
        .withColumn("split_b", F.explode(F.sequence(F.lit(0), F.col("splits") - 1)))
        .filter("low <> low_b OR high <> high_b OR split <= split_b")
        .drop("splits")
    )
    right = tiles.select(*[F.col(c).alias(f"{c}_b") for c in ("low", "high", "split", "codes")])
    met = pairs.join(tiles, ["low", "high", "split"]).join(right, ["low_b", "high_b", "split_b"])
    same = (F.col("low") == F.col("low_b")) & (F.col("high") == F.col("high_b")) & (F.col("split") == F.col("split_b"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                a = batch["codes"][k].values.to_numpy().view(np.uint64)
                if batch["same"][k].as_py():
                    b = a
                else:
                    b = batch["codes_b"][k].values.to_numpy().view(np.uint64)
                left, right = _near(a, b, radius, b is a)
                label = join_local(left, right, len(a) + (0 if b is a else len(b)))
                moved = np.flatnonzero(label != np.arange(len(label)))
                every = (a if b is a else np.concatenate((a, b))).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(every[moved]), pa.array(every[label[moved]])], ["a", "b"])

    # Tiles meet in any order and cost about alike: deal the pairs out evenly.
    dealt = met.select("codes", "codes_b", same.alias("same"))
    return dealt.mapInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, radius: int = 3, shingle: int = 3, seed: int = 42, tile_rows: int = 65_536) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row of ``docs``.

    Documents link if their fingerprints differ in ``radius`` bits or fewer; ``component_id`` is the smallest
    doc_id reachable. Equal fingerprints are one node however many documents share them, so only distinct
    fingerprints (with their smallest doc_id, by partial minima) are tiled, linked and labelled. A null or empty
    text has the fingerprint zero and links like any other; a null doc_id keeps its row and is never the
    smallest; repeated rows come out repeated; an empty table gives an empty result.
    """
    coded = materialise(fingerprints(docs, shingle, seed))
    nodes = materialise(coded.groupBy("code").agg(F.min("doc_id").alias("least")))
    roots = materialise(components(link_codes(nodes.select("code"), radius, tile_rows)))
    rooted = materialise(
        nodes.join(roots.withColumnRenamed("node", "code"), "code", "left").select(
            "code", "least", F.coalesce("root", "code").alias("root")
        )
    )
    smallest = materialise(rooted.groupBy("root").agg(F.min("least").alias("component_id")))
    labelled = materialise(rooted.join(smallest, "root").select("code", "component_id"))
    return coded.join(labelled, "code").select(
        "doc_id", F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame, **how: int) -> DataFrame:
    """One row of each group of near copies: that of the smallest id, of several rows with it the first stored one.

    A null id comes after all others, so a group without any id keeps one row as well. Rows are stored with a
    number, by which they are kept.
    """
    stored = materialise(
        docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("source"), F.monotonically_increasing_id().alias("row"))
    )
    place = F.struct(F.col("source.doc_id").isNull().alias("unknown"), F.col("source.doc_id").alias("id"), "row")
    found = near_duplicates(stored.select(place.alias("doc_id"), F.col("source.text").alias("text")), **how)
    kept = found.filter("doc_id.row = component_id.row").select("doc_id.row")
    return stored.join(kept, "row", "left_semi").select(*[F.col("source")[c].alias(c) for c in docs.columns])
