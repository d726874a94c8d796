"""Tables laid out along a space-filling curve, so that a filter on any of several columns skips files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanloom.functions.shared import materialise

#: Bits of a column's place along the curve.
PLACE_BITS = 8


def value_places(df: DataFrame, columns: Sequence[str], bits: int = PLACE_BITS) -> DataFrame:
    """``name, value, place``: where the rows of each value lie, in 2^bits steps, if the rows are sorted by the column.

    Values are texts in the order in which file statistics compare them, NULL first. One pass counts rows per column
    and value; a place is the middle of the value's rows, so steps hold about equally many rows however rows are spread.
    """
    pairs = F.inline(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in columns]))
    counts = materialise(df.select(pairs).groupBy("name", "value").agg(F.count("*").alias("n")))
    # One row per value of a category column.
    by_name = Window.partitionBy("name")
    before = F.sum("n").over(by_name.orderBy(F.col("value").asc_nulls_first())) - F.col("n") / 2
    share = before / F.sum("n").over(by_name)
    return counts.select("name", "value", F.floor(share * (1 << bits)).cast("int").alias("place"))


def interleaved(places: Sequence[Column], bits: int = PLACE_BITS) -> Column:
    """The place along the curve: the highest bits of all columns in turn, then the next ones, in Gray code order.

    Neighbours on the curve differ in one bit, so a file that runs over a border is wide in one column, not in all.
    """
    if len(places) * bits > 63:
        raise ValueError(f"{len(places)} columns of {bits} bits don't fit a long")
    turn = [F.shiftright(p.cast("long"), b).bitwiseAND(F.lit(1)) for b in range(bits - 1, -1, -1) for p in places]
    # The number of a Gray code: each bit is the parity of the code's bits from the top down to it.
    curve = parity = F.lit(0).cast("long")
    for bit in turn:
        parity = parity.bitwiseXOR(bit)
        curve = F.shiftleft(curve, 1) + parity
    return curve


def write_clustered(df: DataFrame, path: str, columns: Sequence[str], key: str, files: int) -> None:
    """Replace the table at ``path`` by ``df`` in ``files`` files along the curve over category ``columns``.

    Each file holds few values of each column, so the files' minima and maxima let a filter on any of them skip the
    others. Rows of one place go on by ``key``: a combination that holds a third of all rows is cut into
    several files. NULLs are a value of their own; the stored columns are those of ``df``.
    """
    places = materialise(value_places(df, columns))
    placed = df
    for c in columns:
        of = places.filter(F.col("name") == c).select(F.col("value").alias(f"__{c}_value"), F.col("place").alias(f"__{c}"))
        placed = placed.join(of, F.col(c).cast("string").eqNullSafe(F.col(f"__{c}_value")), "left").drop(f"__{c}_value")
    placed = placed.withColumn("__curve", interleaved([F.col(f"__{c}") for c in columns]))
    ranged = placed.repartitionByRange(files, "__curve", key).sortWithinPartitions("__curve", key)
    ranged.select(*df.columns).write.mode("overwrite").parquet(path)


def files_admitted(stored: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``name, value, n_rows, n_files, all_files``: the files that a filter on each value can't skip by minima and maxima."""
    ends = [F.struct(F.min(c).cast("string").alias("low"), F.max(c).cast("string").alias("high")).alias(c) for c in columns]
    files = stored.groupBy(F.col("_metadata.file_path").alias("file")).agg(*ends)
    files = files.select(F.count("*").over(Window.partitionBy(F.lit(0))).alias("all_files"), *columns)  # a row per file
    spans = files.select(
        "all_files", F.inline(F.array(*[F.struct(F.lit(c).alias("name"), f"{c}.low", f"{c}.high") for c in columns]))
    )
    pairs = F.inline(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in columns]))
    values = stored.select(pairs).filter("value IS NOT NULL").groupBy("name", "value").agg(F.count("*").alias("n_rows"))
    met = values.join(spans, "name").filter("value BETWEEN low AND high")
    return met.groupBy("name", "value", "n_rows").agg(F.count("*").alias("n_files"), F.max("all_files").alias("all_files"))
