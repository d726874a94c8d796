"""Path-dependent Shapley values of boosted trees, in time leaves x depth^2.

A leaf is reached by conditions on the few features of its path. Its value is shared among them by the weights of
all orders in which conditions become known, an unknown one standing for the share of training rows behind it. These
weights are a polynomial that grows by one factor for each feature of the path, and taking one feature out again
gives that feature's share. Rows and leaves are handled as arrays; the loops run over the path alone.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanloom.functions.shared import shared_folder

#: Rows x leaves that are worked on at a time.
CELLS = 200_000
#: Rows that are looked up at a time, comparisons that one table of shares spans, and the size of all tables of a model.
LOOKUP_ROWS, TABLE_BITS, TABLE_BYTES = 8192, 8, 64_000_000


class Leaf(NamedTuple):
    """Conditions lower < x <= upper on the features of a path, the share of training rows that meets each, and
    the leaf's value in log-odds."""

    features: np.ndarray
    lower: np.ndarray
    upper: np.ndarray
    absent: np.ndarray
    value: float


class Paths(NamedTuple):
    """All leaves side by side; shorter paths are filled up with conditions that every row meets, which change no
    other feature's share."""

    features: np.ndarray
    lower: np.ndarray
    upper: np.ndarray
    absent: np.ndarray
    values: np.ndarray


class Table(NamedTuple):
    """Some leaves at once: ``shares[j, p]`` is what they give ``columns[j]`` in a row whose comparisons
    ``features[b] <= thresholds[b]`` are the bits of p."""

    features: list[int]
    thresholds: list[float]
    columns: list[int]
    shares: np.ndarray


def tree_nodes(spark: SparkSession, trees: GBTClassificationModel) -> DataFrame:
    """The nodes of all trees as a flat table; ``cover`` is the weight of the training rows of the first class."""
    folder = shared_folder(spark, "tree-nodes")
    trees.write().overwrite().save(folder)
    return spark.read.parquet(f"{folder}/data").select(
        "treeID",
        F.col("nodeData.id").alias("id"),
        F.col("nodeData.prediction").alias("value"),
        F.col("nodeData.impurityStats")[0].alias("cover"),
        F.col("nodeData.leftChild").alias("left"),
        F.col("nodeData.rightChild").alias("right"),
        F.col("nodeData.split.featureIndex").alias("feature"),
        F.try_element_at("nodeData.split.leftCategoriesOrThreshold", F.lit(1)).alias("threshold"),
    )


def leaves(spark: SparkSession, trees: GBTClassificationModel) -> list[Leaf]:
    """All leaves of a model; as many as it has, rounds x 2^depth at most."""
    nodes = {(r.treeID, r.id): r for r in tree_nodes(spark, trees).collect()}
    found = []
    for tree, weight in enumerate(trees.treeWeights):
        stack: list[tuple[int, dict]] = [(0, {})]
        while stack:
            node_id, path = stack.pop()
            node = nodes[(tree, node_id)]
            if node.left < 0:
                sides = np.array(list(path.values()), float).reshape(-1, 3).T
                # P(default) is the logistic of twice the margin.
                found.append(Leaf(np.array(list(path), int), *sides, 2.0 * weight * node.value))
                continue
            for child, goes_left in ((node.left, True), (node.right, False)):
                low, high, share = path.get(node.feature, (-np.inf, np.inf, 1.0))
                low, high = (low, min(high, node.threshold)) if goes_left else (max(low, node.threshold), high)
                share *= nodes[(tree, child)].cover / node.cover
                stack.append((child, {**path, node.feature: (low, high, share)}))
    return found


def mean_value(found: list[Leaf]) -> float:
    """Mean log-odds of the model over its training cover."""
    return float(sum(leaf.value * np.prod(leaf.absent) for leaf in found))


def pack(found: list[Leaf]) -> Paths:
    """Leaves x depth x 28 bytes: 0.4 MB for 200 trees of depth 4, 12 MB for 200 of depth 8."""
    depth = max([1, *(len(leaf.features) for leaf in found)])
    shape = (len(found), depth)
    out = Paths(
        np.zeros(shape, np.int32), np.full(shape, -np.inf), np.full(shape, np.inf), np.ones(shape), np.zeros(len(found))
    )
    for k, leaf in enumerate(found):
        n = len(leaf.features)
        out.features[k, :n], out.lower[k, :n], out.upper[k, :n], out.absent[k, :n] = leaf[:4]
        out.values[k] = leaf.value
    return out


def contributions(x: np.ndarray, paths: Paths) -> np.ndarray:
    """The share of every feature (columns) in the log-odds of every row.

    A missing value goes where the trees send it: it is below no threshold, so it meets no upper bound.
    """
    out = np.zeros_like(x, dtype=float)
    step = max(1, CELLS // max(1, len(paths.values)))
    for at in range(0, len(x), step):
        _add_shares(x[at : at + step], paths, out[at : at + step])
    return out


def _add_shares(x: np.ndarray, paths: Paths, out: np.ndarray) -> None:
    depth = paths.features.shape[1]
    met = []
    for k in range(depth):
        own, upper = x[:, paths.features[:, k]], paths.upper[:, k]
        met.append(~(own <= paths.lower[:, k]) & ((own <= upper) | np.isposinf(upper)))
    _add_met(met, paths, out)


def _add_met(met: list[np.ndarray], paths: Paths, out: np.ndarray) -> None:
    """Add the shares of rows for which ``met[k]`` tells whether they meet the k-th condition of each leaf."""
    depth = len(met)

    # Weight of the orders in which so many of the path's conditions are known.
    weight = [np.ones(met[0].shape)]
    for d in range(1, depth + 1):
        absent = paths.absent[:, d - 1]
        weight.append(np.zeros_like(weight[0]))
        for i in range(d - 1, -1, -1):
            weight[i + 1] += weight[i] * (met[d - 1] * ((i + 1) / (d + 1)))
            weight[i] *= absent * ((d - i) / (d + 1))

    for k in range(depth):
        absent = paths.absent[:, k]
        # Without this feature: its factor is divided out of the polynomial, from the highest power down if its
        # condition is met, from the lowest up if not.
        with_it, without, above = 0.0, 0.0, weight[depth]
        for i in range(depth - 1, -1, -1):
            part = above * ((depth + 1) / (i + 1))
            with_it = with_it + part
            above = weight[i] - part * (absent * ((depth - i) / (depth + 1)))
            without = without + weight[i] * ((depth + 1) / (depth - i))
        share = np.where(met[k], with_it * (1 - absent), -without) * paths.values
        order = np.argsort(paths.features[:, k], kind="stable")
        features, first = np.unique(paths.features[order, k], return_index=True)
        if len(features):
            out[:, features] += np.add.reduceat(share[:, order], first, axis=1)


def _comparisons(leaf: Leaf) -> set[tuple[int, float]]:
    """The comparisons (feature, threshold) that tell which conditions of a leaf a row meets."""
    sides = [(f, t) for f, t in zip(leaf.features.tolist(), leaf.lower.tolist()) if t > -np.inf]
    return {*sides, *((f, t) for f, t in zip(leaf.features.tolist(), leaf.upper.tolist()) if t < np.inf)}


def tables(found: list[Leaf]) -> list[Table] | None:
    """The shares of neighbouring leaves for every outcome of their comparisons; None if they would not fit.

    The polynomial is then worked out once for each outcome instead of once for each row. 200 trees of depth 4 take
    400 tables of 256 outcomes, 7 MB; trees that are deeper than a table has bits have none.
    """
    groups: list[tuple[list[Leaf], set]] = []
    for leaf in found:
        own = _comparisons(leaf)
        if len(own) > TABLE_BITS:
            return None
        if not groups or len(groups[-1][1] | own) > TABLE_BITS:
            groups.append(([], set()))
        groups[-1][0].append(leaf)
        groups[-1][1].update(own)
    columns = [sorted({f for leaf in group for f in leaf.features.tolist()}) for group, _ in groups]
    if sum(8 * len(c) * 2 ** len(known) for c, (_, known) in zip(columns, groups)) > TABLE_BYTES:
        return None
    return [_table(group, sorted(known), own) for (group, known), own in zip(groups, columns)]


def _table(group: list[Leaf], known: list[tuple[int, float]], columns: list[int]) -> Table:
    place = {c: b for b, c in enumerate(known)}
    # A condition without a bound is met whatever the outcome: two more columns, never and always.
    outcomes = (np.arange(2 ** len(known))[:, None] >> np.arange(len(known))) & 1 == 1
    outcomes = np.column_stack([outcomes, np.zeros(len(outcomes), bool), np.ones(len(outcomes), bool)])
    never, always = len(known), len(known) + 1
    at = {f: j for j, f in enumerate(columns)}
    local = [leaf._replace(features=np.array([at[f] for f in leaf.features.tolist()], int)) for leaf in group]
    paths = pack(local)
    met = []
    for k in range(paths.features.shape[1]):
        own = [columns[f] if columns else 0 for f in paths.features[:, k].tolist()]
        lower = [place.get((f, t), never) for f, t in zip(own, paths.lower[:, k].tolist())]
        upper = [place.get((f, t), always) for f, t in zip(own, paths.upper[:, k].tolist())]
        met.append(~outcomes[:, lower] & outcomes[:, upper])
    shares = np.zeros((len(outcomes), max(1, len(columns))))
    _add_met(met, paths, shares)
    return Table([f for f, _ in known], [t for _, t in known], columns, np.ascontiguousarray(shares.T))


def looked_up(x: np.ndarray, known: list[Table]) -> np.ndarray:
    """``contributions`` by the tables of the leaves: comparisons and look-ups alone."""
    out = np.zeros_like(x, dtype=float)
    for at in range(0, len(x), LOOKUP_ROWS):
        rows = np.ascontiguousarray(x[at : at + LOOKUP_ROWS].T)
        sums = np.zeros_like(rows)
        for table in known:
            outcome = np.zeros(rows.shape[1], np.uint8)
            for b, (f, t) in enumerate(zip(table.features, table.thresholds)):
                outcome |= (rows[f] <= t).view(np.uint8) << np.uint8(b)
            place = outcome.astype(np.intp)
            for f, shares in zip(table.columns, table.shares):
                sums[f] += shares.take(place)
        out[at : at + LOOKUP_ROWS] = sums.T
    return out
