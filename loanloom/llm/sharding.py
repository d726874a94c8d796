"""Sharding by extendible hashing: only oversized buckets split, on one more bit of the key's hash."""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.shared import materialise, release

#: Bits of a hash word, and the most bits a bucket's address can have: the key's word, then the row's word.
WORD, DEEPEST = 60, 120


def hash_bits(key: Column) -> Column:
    """60 bits of the MD5 of a key's text."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")


def _prefix(depth: int) -> list[Column]:
    """The first ``depth`` bits of a row, as two numbers."""
    return [
        F.shiftright("key_bits", WORD - min(depth, WORD)).alias("key_prefix"),
        F.shiftright("row_bits", WORD - max(0, depth - WORD)).alias("row_prefix"),
    ]


def _bits(depth: int) -> Column:
    def text(prefix: str, n: int) -> Column:
        return F.lpad(F.bin(prefix), n, "0") if n else F.lit("")

    return F.concat(text("key_prefix", min(depth, WORD)), text("row_prefix", max(0, depth - WORD)))


def _hashed(docs: DataFrame, key: Column, text: Column, row: Column) -> DataFrame:
    """``key, n_bytes, key_bits, row, row_bits``, all that sharding needs to know of a row; stored."""
    rows = docs.select(
        key.alias("key"),
        F.octet_length(F.coalesce(text, F.lit(""))).cast("long").alias("n_bytes"),
        hash_bits(key).alias("key_bits"),
        row.alias("row"),
    )
    return materialise(rows.withColumn("row_bits", hash_bits(F.col("row"))))


def _over(byte_limit: int) -> Column:
    return (F.col("shard_bytes") > byte_limit) & (F.col("shard_rows") > 1)


def _first_directory(rows: DataFrame, depth: int, byte_limit: int) -> DataFrame:
    """The directory of ``depth`` bits: each ``entry`` with its bucket (``bucket, depth, shard_bytes, shard_rows``).

    Rows are summed up once by their first ``depth`` bits. Sums of shorter prefixes are sums of these; a bucket is
    the shortest prefix that need not split: it is not over the limit, or has all its bits, and its parent is.
    """
    entry = F.shiftright("key_bits", WORD - depth)
    deep = materialise(
        rows.groupBy(entry.alias("entry")).agg(F.sum("n_bytes").alias("shard_bytes"), F.count("*").alias("shard_rows"))
    )
    levels = deep.select(F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("depth"), "*")
    sums = materialise(
        levels.groupBy("depth", F.expr(f"shiftright(entry, {depth} - depth)").alias("bucket"))
        .agg(F.sum("shard_bytes").alias("shard_bytes"), F.sum("shard_rows").alias("shard_rows"))
        .withColumn("over", _over(byte_limit))
    )
    parents = sums.filter("over").select((F.col("depth") + 1).alias("depth"), F.col("bucket").alias("parent"))
    halves = sums.filter(~F.col("over") | (F.col("depth") == depth)).withColumn("parent", F.shiftright("bucket", 1))
    buckets = halves.filter("depth = 0").unionByName(halves.join(parents, ["depth", "parent"], "left_semi"))
    rest = f"{depth} - depth"
    entries = F.expr(f"sequence(shiftleft(bucket, {rest}), shiftleft(bucket + 1, {rest}) - 1)")
    return buckets.select(F.explode(entries).alias("entry"), "bucket", "depth", "shard_bytes", "shard_rows")


_SHARD = ("row", "key", "n_bytes", "shard", "depth", "shard_bytes", "shard_rows")


def _dealt(rows: DataFrame, byte_limit: int) -> DataFrame:
    """``_SHARD`` of stored rows (``key, n_bytes, key_bits, row, row_bits``)."""
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    depth = min(WORD, max(0, ceil(log2(max(1, total / byte_limit)))))
    first = materialise(_first_directory(rows, depth, byte_limit))
    entry = F.shiftright("key_bits", WORD - depth).alias("entry")
    address = F.expr("lpad(bin(bucket), depth, '0')").alias("shard")
    placed = rows.select("row", "key", "n_bytes", entry).join(first.filter(~_over(byte_limit)), "entry")
    out = placed.select(*[address if c == "shard" else c for c in _SHARD])
    split = first.filter(_over(byte_limit)).select("entry")
    if split.isEmpty():
        return out
    live = materialise(rows.withColumn("entry", entry).join(split, "entry", "left_semi").select(*rows.columns))
    while True:
        depth += 1
        sums = materialise(
            live.groupBy(*_prefix(depth)).agg(F.sum("n_bytes").alias("shard_bytes"), F.count("*").alias("shard_rows"))
        )
        over = _over(byte_limit) & F.lit(depth < DEEPEST)
        done = live.select("row", "key", "n_bytes", *_prefix(depth)).join(sums.filter(~over), ["key_prefix", "row_prefix"])
        told = {"shard": _bits(depth).alias("shard"), "depth": F.lit(depth).alias("depth")}
        out = out.unionByName(done.select(*[told.get(c, c) for c in _SHARD]))
        split = sums.filter(over).select("key_prefix", "row_prefix")
        if split.isEmpty():
            return out
        live = materialise(
            live.select("*", *_prefix(depth))
            .join(split, ["key_prefix", "row_prefix"], "left_semi")
            .select(*rows.columns)
        )


def assign_shards(docs: DataFrame, byte_limit: int, key: str = "doc_id") -> DataFrame:
    """``key, n_bytes, shard, depth, shard_bytes, shard_rows, over_limit`` of every row of ``docs``.

    ``shard`` is the bucket's address, the first ``depth`` bits of the key's hash as text. The directory starts as
    one bucket; only buckets over the limit split, on another bit, until every one fits. The first
    ``log2(total / byte_limit)`` bits are counted in one pass; the rows of entries that are still over the limit, and
    no others, are counted again by one more bit. Rows with one key have one hash: beyond its 60 bits a bucket
    splits on bits of the row's number, so a key that holds a third of all rows is split as well. Only a row that
    is over the limit by itself stays so; it gets a shard of its own and ``over_limit``.

    Sums are partial before they are shuffled and rows of 16 bytes take part, never texts. A null text has 0
    bytes, a null key hashes as the empty text, repeated rows stay apart, an empty table gives an empty result.
    """
    dealt = _dealt(_hashed(docs, F.col(key), F.col("text"), F.monotonically_increasing_id()), byte_limit)
    return dealt.select(
        F.col("key").alias(key), *_SHARD[2:], (F.col("shard_bytes") > byte_limit).alias("over_limit")
    )


def directory(shards: DataFrame) -> DataFrame:
    """The directory of 2^g entries, g the greatest depth: ``entry`` bits and the ``shard`` they lead to.

    Grows with the number of shards; a shard of depth d is the target of 2^(g-d) entries.
    """
    buckets = shards.select("shard", "depth").distinct()
    deepest = buckets.agg(F.max("depth")).first()[0] or 0
    tails = F.expr(f"explode(sequence(0L, shiftleft(1L, {deepest} - depth) - 1))")
    return buckets.select("shard", "depth", tails.alias("tail")).select(
        F.expr(f"concat(shard, lpad(bin(tail), {deepest} - depth, '0'))").alias("entry"), "shard"
    )


def write_shards(docs: DataFrame, path: str, byte_limit: int, key: str = "doc_id") -> None:
    """Write ``docs`` as one folder per shard below ``path``, each of at most ``byte_limit`` bytes of text.

    Folders are named by ``b`` and the shard's bits, so that no reader takes them for numbers. Rows are stored with a
    number and meet their shards by it: null and repeated keys lose and multiply nothing. An empty table writes no
    folder. A column of ``docs`` named ``shard`` would clash with the folders' and has to be renamed before.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole")
    stored = materialise(docs.select(whole, F.monotonically_increasing_id().alias("row")))
    rows = _hashed(stored, F.col("whole")[key], F.col("whole")["text"], F.col("row"))
    shards = materialise(_dealt(rows, byte_limit).select("row", F.concat(F.lit("b"), "shard").alias("shard")))
    dealt = stored.join(shards, "row").select("whole.*", "shard").repartition("shard")
    dealt.write.partitionBy("shard").option("maxRecordsPerFile", 0).parquet(path)
    release(stored)
