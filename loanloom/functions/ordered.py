"""Exact ranks, running totals and quantiles without sorting a whole group in one task.

Rows are first collapsed to one row per distinct value, with partial
aggregation before the shuffle, so a value shared by a third of the table costs
no more than a rare one. Running totals over those rows are then taken in two
levels: totals per value bucket, and a window inside each bucket. With money
stored as DECIMAL(12,2) and buckets of 10,000 units, no window partition can
exceed 10^6 rows at either level, whatever the number of loans.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanloom.functions.shared import materialise

_BUCKET = "__bucket"


def money_bucket(value: Column) -> Column:
    return F.floor(value.cast("double") / 10000)


def probability_bucket(value: Column) -> Column:
    return F.floor(value.cast("double") * 1000000)


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL keys match each other; the left key columns are kept."""
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys]
    return left.join(renamed, on, how).drop(*[f"__r_{k}" for k in keys])


def totals_before(
    hist: DataFrame,
    keys: Sequence[str],
    value: str,
    measures: Sequence[str],
    bucket: Column | None = None,
    descending: bool = False,
) -> DataFrame:
    """Add ``<measure>_before`` and ``<measure>_total``: sums over strictly earlier values, and over all, of the keys.

    ``hist`` holds one row per (keys, value). ``bucket`` must not decrease as
    ``value`` grows. NULL values come first ascending and last descending.
    """

    def ordered(columns: Sequence[str], by: str):
        order = F.col(by).desc_nulls_last() if descending else F.col(by).asc_nulls_first()
        window = Window.partitionBy(*(columns or [F.lit(0)])).orderBy(order)
        return window.rowsBetween(Window.unboundedPreceding, -1)

    def running(measure: str, window) -> Column:
        return F.coalesce(F.sum(measure).over(window), F.lit(0))

    group = Window.partitionBy(*(keys or [F.lit(0)]))
    if bucket is None:
        fine = ordered(keys, value)
        before = {f"{m}_before": running(m, fine) for m in measures}
        return hist.withColumns(before | {f"{m}_total": F.sum(m).over(group) for m in measures})

    binned = hist.withColumn(_BUCKET, bucket)
    coarse = ordered(keys, _BUCKET)
    offsets = (
        binned.groupBy(*keys, _BUCKET)
        .agg(*[F.sum(m).alias(m) for m in measures])
        .select(
            *keys,
            _BUCKET,
            *[running(m, coarse).alias(f"{m}_offset") for m in measures],
            *[F.sum(m).over(group).alias(f"{m}_total") for m in measures],
        )
    )
    fine = ordered([*keys, _BUCKET], value)
    return (
        null_safe_join(binned, offsets, [*keys, _BUCKET])
        .withColumns({f"{m}_before": F.col(f"{m}_offset") + running(m, fine) for m in measures})
        .drop(_BUCKET, *[f"{m}_offset" for m in measures])
    )


def positions(
    points: DataFrame,
    hist: DataFrame,
    keys: Sequence[str],
    value: str,
    bucket: Column | None = None,
    measures: Sequence[str] = ("n",),
) -> DataFrame:
    """Place every distinct (keys, value) of ``points`` in the ordered counts of ``hist``.

    ``hist`` has columns keys, value, and the measures, ``n`` among them.
    Returns keys, value, ``n_below`` (strictly lower), ``n_equal`` and the
    ``<measure>_total`` of the keys. Values absent from ``hist`` are placed
    too, which replaces a range join by a union and a running total.
    """
    zeros = [F.lit(0).cast("long").alias(m) for m in measures]
    wanted = points.select(*keys, value, *zeros, F.lit(1).alias("__wanted"))
    longs = [F.coalesce(F.col(m).cast("long"), F.lit(0)).alias(m) for m in measures]
    known = hist.select(*keys, value, *longs, F.lit(0).alias("__wanted"))
    merged = (
        known.unionByName(wanted)
        .groupBy(*keys, value)
        .agg(*[F.sum(m).alias(m) for m in measures], F.max("__wanted").alias("__wanted"))
    )
    placed = totals_before(materialise(merged), keys, value, list(measures), bucket)
    return placed.filter("__wanted = 1").select(
        *keys,
        value,
        F.col("n_before").alias("n_below"),
        F.col("n").alias("n_equal"),
        *[f"{m}_total" for m in measures],
    )


def exact_quantiles(
    df: DataFrame, column: str, qs: Sequence[float], bucket: Column | None = None
) -> DataFrame:
    """One row, one column ``quantiles array<double>``, linearly interpolated like a sorted-list percentile.

    Nothing but per-value counts is shuffled, so it stays exact on columns whose
    distinct values would not fit the buffer of one aggregation task.
    """
    hist = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return quantiles_of_counts(hist, column, qs, bucket)


def quantiles_of_counts(
    hist: DataFrame, column: str, qs: Sequence[float], bucket: Column | None = None
) -> DataFrame:
    """``exact_quantiles`` of values already counted, as (value, ``n``) without NULL values."""
    placed = totals_before(hist, [], column, ["n"], bucket).withColumn("__last", F.col("n_total") - 1)

    def at(rank: Column) -> Column:
        hit = (F.col("n_before") <= rank) & (rank < F.col("n_before") + F.col("n"))
        return F.max(F.when(hit, F.col(column).cast("double")))

    aggregates = []
    for i, q in enumerate(qs):
        place = F.col("__last") * F.lit(float(q))
        aggregates += [at(F.floor(place)).alias(f"lo{i}"), at(F.ceil(place)).alias(f"hi{i}")]
        aggregates.append(F.max(place - F.floor(place)).alias(f"w{i}"))
    row = placed.agg(*aggregates)
    return row.select(
        F.array(
            *[F.col(f"lo{i}") + (F.col(f"hi{i}") - F.col(f"lo{i}")) * F.col(f"w{i}") for i in range(len(qs))]
        ).alias("quantiles")
    )
