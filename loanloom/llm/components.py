"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.shared import materialise


def components(links: DataFrame) -> DataFrame:
    """``node, root`` of every node of ``links`` (``a, b``, two columns of one type; both directions are implied).

    ``root`` is one node of the component, the same for all of it. Each round gives every node the neighbour (or
    itself) that comes first in an order drawn anew by hash, and contracts the graph along that choice; about
    half of the nodes or more vanish, so rounds grow with the logarithm of the longest chain. Then the choices of
    the rounds are followed backwards. A hub is no large group anywhere: choices are minima with partial sums,
    and joins meet a written table on a unique key, so their hot side can be split. Nulls link nothing, loops and
    repeated links do no harm, an empty table gives an empty result.
    """
    edges = materialise(links.select("a", "b").filter("a <> b").distinct())
    chosen: list[DataFrame] = []
    while not edges.isEmpty():
        order = F.xxhash64(F.lit(len(chosen)), "other")
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).union(
            edges.select(F.col("b").alias("node"), F.col("a").alias("other"))
        )
        loops = edges.select(F.explode(F.array("a", "b")).alias("node")).select("node", F.col("node").alias("other"))
        ranked = both.union(loops).select("node", "other", order.alias("rank"))
        first = materialise(ranked.groupBy("node").agg(F.min("rank").alias("rank")))
        choice = materialise(
            ranked.join(first, ["node", "rank"]).groupBy("node").agg(F.min("other").alias("chosen"))
        )
        chosen.append(choice)
        left = choice.select(F.col("node").alias("a"), F.col("chosen").alias("x"))
        right = choice.select(F.col("node").alias("b"), F.col("chosen").alias("y"))
        moved = edges.join(left, "a").join(right, "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
        edges = materialise(moved.filter("a <> b").distinct())
    if not chosen:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = chosen.pop().withColumnRenamed("chosen", "root")
    while chosen:
        step = chosen.pop()
        later = roots.select(F.col("node").alias("chosen"), F.col("root").alias("later"))
        roots = materialise(
            step.join(later, "chosen", "left").select("node", F.coalesce("later", "chosen").alias("root"))
        )
    return roots


def join_local(left, right, n: int):
    """Labels 0..n-1 of the components of ``n`` local nodes under the link arrays ``left`` and ``right``."""
    import numpy as np

    label = np.arange(n)
    while True:
        x, y = label[left], label[right]
        apart = x != y
        if not apart.any():
            return label
        x, y = x[apart], y[apart]
        left, right = left[apart], right[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
