"""Seeded samples and stratified splits that do not depend on partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanloom.functions.ordered import null_safe_join, totals_before
from loanloom.functions.shared import materialise

SPLITS = ("train", "calibration", "test")
_MODULUS = 1000003
_MULTIPLIER = 2654435761


def modular_hash(id_col: Column, seed: int = 42) -> Column:
    """Integer hash in [0, 1000003) from arithmetic any SQL engine shares."""
    return ((id_col % _MODULUS) * _MULTIPLIER + seed * 7919) % _MODULUS


def wide_hash(id_col: Column, seed: int = 42) -> Column:
    """63-bit hash in [0, 2^63)."""
    return F.xxhash64(F.lit(seed), id_col).bitwiseAND(F.lit(2**63 - 1))


def _hash(method: str, id_col: str, seed: int) -> tuple[Column, int]:
    if method == "wide":
        return wide_hash(F.col(id_col), seed), 2**63
    if method == "modular":
        return modular_hash(F.col(id_col), seed), _MODULUS
    raise ValueError(f"unknown hash method: {method}")


def sample_n(df: DataFrame, n: int, id_col: str, seed: int = 42, method: str = "wide") -> DataFrame:
    """Exactly ``n`` rows (all, if there are fewer): those with the smallest seeded hash of their unique id.

    Only the rows of the one hash bucket in which the n-th row falls are sorted;
    about one row in a million at full size.
    """
    h, span = _hash(method, id_col, seed)
    buckets = min(span, 2**20)
    marked = df.withColumn("__h", h)
    bucket = F.floor(F.col("__h") / (span // buckets)) if span > buckets else F.col("__h")
    marked = marked.withColumn("__b", bucket)
    counts = marked.groupBy(F.col("__b")).agg(F.count("*").alias("n"))
    # Two-level running total over at most 2^20 + 1 bucket counts.
    placed = totals_before(counts, [], "__b", ["n"], F.floor(F.col("__b") / 1024))
    edge = (
        placed.filter(F.col("n_before") < n)
        .agg(F.max(F.struct(F.col("__b").alias("b"), (n - F.col("n_before")).alias("room"))).alias("edge"))
    )
    edge = materialise(edge).scalar()
    inside = marked.filter(F.col("__b") < edge.getField("b"))
    order = Window.partitionBy("__b").orderBy("__h", id_col)
    boundary = (
        marked.filter(F.col("__b") == edge.getField("b"))
        .withColumn("__rank", F.row_number().over(order))
        .filter(F.col("__rank") <= edge.getField("room"))
        .drop("__rank")
    )
    return inside.unionByName(boundary).drop("__h", "__b")


def hash_split(
    df: DataFrame, id_col: str, weights: Sequence[float] = (0.6, 0.2, 0.2), seed: int = 42, method: str = "wide"
) -> DataFrame:
    """Add ``split`` by each id's hash alone: nothing is counted or shuffled, a row keeps its split when others
    arrive, and shares are met up to sampling noise. Not stratified."""
    h, span = _hash(method, id_col, seed)
    share = h / F.lit(float(span))
    train, calibration = weights[0], weights[0] + weights[1]
    name = F.when(share < train, SPLITS[0]).when(share < calibration, SPLITS[1]).otherwise(SPLITS[2])
    return df.withColumn("split", name)


def stratified_split(
    df: DataFrame,
    label: str,
    id_col: str,
    weights: Sequence[float] = (0.6, 0.2, 0.2),
    seed: int = 42,
    method: str = "wide",
) -> DataFrame:
    """Add ``split``: train, calibration or test, with shares met to the row within each value of ``label``.

    In the order of the seeded hash (ties by id) the first round(share x stratum) rows of a stratum are train, the
    next calibration. Hash buckets are counted per stratum, only the rows of the bucket in which a cut falls are
    sorted, and every row is then compared with the two cuts of its stratum: no window and no shuffle over ``df``.
    """
    h, span = _hash(method, id_col, seed)
    buckets = min(span, 2**20)
    cell = F.floor(F.col("__h") / (span // buckets)) if span > buckets else F.col("__h")
    marked = df.withColumn("__h", h).withColumn("__b", cell)
    counts = marked.groupBy(label, "__b").agg(F.count("*").alias("n"))
    places = materialise(totals_before(counts, [label], "__b", ["n"], F.floor(F.col("__b") / 1024)))
    strata = places.groupBy(label).agg(F.sum("n").alias("__stratum"))
    wanted = F.array(
        *[
            F.struct(F.lit(k).alias("__cut"), F.round(F.col("__stratum") * share).alias("__rows"))
            for k, share in enumerate((weights[0], weights[0] + weights[1]))
        ]
    )
    sized = materialise(strata.select(label, F.inline(wanted)))
    edges = null_safe_join(places, sized, [label]).filter(
        (F.col("n_before") < F.col("__rows")) & (F.col("__rows") <= F.col("n_before") + F.col("n"))
    )
    edges = materialise(edges.select(label, "__b", "__cut", (F.col("__rows") - F.col("n_before")).alias("__room")))
    last = (
        null_safe_join(marked.select(label, "__b", "__h", F.col(id_col).alias("__id")), edges, [label, "__b"])
        .withColumn("__rank", F.row_number().over(Window.partitionBy(label, "__b", "__cut").orderBy("__h", "__id")))
        .filter("__rank = __room")
    )
    at = F.struct(F.col("__h"), F.col("__id"))
    cuts = materialise(
        last.groupBy(label).agg(
            F.max(F.when(F.col("__cut") == 0, at)).alias("__first"), F.max(F.when(F.col("__cut") == 1, at)).alias("__second")
        )
    )  # a row for each stratum
    here = F.struct(F.col("__h"), F.col(id_col).alias("__id"))
    split = F.when(here <= F.col("__first"), SPLITS[0]).when(here <= F.col("__second"), SPLITS[1]).otherwise(SPLITS[2])
    placed = null_safe_join(marked, cuts, [label], "left")
    return placed.withColumn("split", split).select(*df.columns, "split")
