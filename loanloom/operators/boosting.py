"""Boosted trees from histograms: the trees of MLlib's ``GBTClassifier``, grown in fewer and lighter passes.

The rules are MLlib's: bins by thresholds of a seeded sample of some 10,000 rows, regression trees on the gradient of
the logistic loss, split by weighted variance, the first tree in full and all others shrunk. Every round reads every
row. A row is stored as a few packed codes, each the bins of several features, so one count per code serves them all;
of two children only the smaller is counted, the other is what remains of their parent. The margins are one number a
row, in a table of their own that is written to shared storage every few rounds.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Callable, Iterable, Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.serializers import BatchedSerializer, CPickleSerializer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanloom.functions.shared import delete_folder, shared_folder

#: Rows of a block, outcomes of one packed code, tasks whose counts the driver adds up by itself.
BLOCK_ROWS, CODE_BINS, DIRECT_TASKS = 65_536, 1024, 64
#: Gains this close, relative to the best, are equal: the first feature and threshold wins, whatever the order of sums.
TIE, NOISE = 1e-9, 1e-12


class Bins(NamedTuple):
    """Thresholds of every feature, and for each packed code its (feature, stride) pairs and its number of outcomes."""

    thresholds: list[np.ndarray]
    groups: list[list[tuple[int, int]]]
    sizes: list[int]

    @property
    def width(self) -> int:
        return 1 + max((len(t) for t in self.thresholds), default=0)

    def place(self, feature: int) -> tuple[int, np.ndarray]:
        """The code that a feature is in, and its bin for each outcome of that code."""
        for g, group in enumerate(self.groups):
            for f, stride in group:
                if f == feature:
                    return g, np.arange(self.sizes[g]) // stride % (len(self.thresholds[f]) + 1)
        raise KeyError(feature)


class Block(NamedTuple):
    """Rows of a task, defaults first: an array per packed code, and how many rows are defaults."""

    codes: list[np.ndarray]
    n_positive: int


class Node(NamedTuple):
    """Weight, weighted sum of the targets and rows of a node; root 1, children 2 k and 2 k + 1."""

    weight: float
    total: float
    rows: int


class Split(NamedTuple):
    feature: int
    bin: int
    gain: float


class Tree(NamedTuple):
    nodes: dict[int, Node]
    splits: dict[int, Split]
    squares: dict[int, float]


# -- bins ---------------------------------------------------------------------------------


def feature_thresholds(values: np.ndarray, weights: np.ndarray, expected: float, n_splits: int) -> np.ndarray:
    """Candidate thresholds of one feature from sampled values, whose weights add up to ``expected`` on average."""
    known = values != 0.0
    distinct, place = np.unique(values[known], return_inverse=True)
    sums = np.bincount(place, weights=weights[known], minlength=len(distinct))
    # What the other values leave of the expected weight belongs to zero.
    zeros = expected - sums.sum()
    if len(distinct) and zeros > np.finfo(float).eps * known.sum() * 100:
        at = int(np.searchsorted(distinct, 0.0))
        distinct, sums = np.insert(distinct, at, 0.0), np.insert(sums, at, zeros)
    middles = (distinct[:-1] + distinct[1:]) / 2.0
    if len(middles) <= n_splits:
        return middles
    stride = expected / (n_splits + 1)
    found, target, current = [], stride, float(sums[0])
    for k in range(1, len(distinct)):
        previous, current = current, current + float(sums[k])
        if abs(previous - target) < abs(current - target):
            found.append(middles[k - 1])
            target += stride
    return np.array(found)


def pack_features(thresholds: list[np.ndarray], most: int = CODE_BINS) -> Bins:
    """Features dealt to codes of at most ``most`` outcomes; a constant feature needs none."""
    groups: list[list[tuple[int, int]]] = []
    sizes: list[int] = []
    wide_first = sorted((f for f, t in enumerate(thresholds) if len(t)), key=lambda f: (-len(thresholds[f]), f))
    for f in wide_first:
        n = len(thresholds[f]) + 1
        g = next((g for g, size in enumerate(sizes) if size * n <= most), None)
        if g is None:
            g = len(groups)
            groups.append([])
            sizes.append(1)
        groups[g].append((f, sizes[g]))
        sizes[g] *= n
    if not groups:
        groups, sizes = [[(0, 1)]], [1]
    return Bins(thresholds, groups, sizes)


def find_bins(rows: DataFrame, n: int, weight: float, positive: float, max_bins: int, seed: int) -> Bins:
    """Thresholds from a seeded sample of max(max_bins^2, 10,000) rows, all of them if there are fewer."""
    wanted = max(max_bins * max_bins, 10_000)
    share = wanted / n if wanted < n else 1.0
    sampled = rows if share == 1.0 else rows.sample(False, share, seed)
    columns = sampled.select(vector_to_array("x").alias("x"), "y").toArrow()
    x = _matrix(columns["x"].combine_chunks())
    weights = np.where(columns["y"].to_numpy() == 1, positive, 1.0)
    n_splits = min(max_bins, n) - 1
    return pack_features([feature_thresholds(x[:, f], weights, share * weight, n_splits) for f in range(x.shape[1])])


def _matrix(vectors: pa.Array) -> np.ndarray:
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1)


def encode(x: np.ndarray, bins: Bins) -> list[np.ndarray]:
    codes = []
    for group, size in zip(bins.groups, bins.sizes):
        code = np.zeros(len(x), np.int64)
        for f, stride in group:
            code += np.searchsorted(bins.thresholds[f], x[:, f]) * stride
        codes.append(code.astype(np.uint16 if size <= 2**16 else np.int64))
    return codes


def _block(codes: list[list[np.ndarray]], labels: list[np.ndarray]) -> Block:
    positive = np.concatenate(labels) == 1
    order = np.argsort(~positive, kind="stable")
    return Block([np.concatenate(c)[order] for c in zip(*codes)], int(positive.sum()))


def _stored_blocks(batches: Iterable[pa.RecordBatch], bins: Bins) -> Iterator[pa.RecordBatch]:
    """Blocks as rows of bytes: the codes one after the other, and two counts."""

    def stored(block: Block, n: int) -> pa.RecordBatch:
        content = [c.astype(np.int64).tobytes() if c.dtype != np.uint16 else c.tobytes() for c in block.codes]
        return pa.RecordBatch.from_pydict(
            {"codes": pa.array([content], pa.list_(pa.binary())), "n_positive": [block.n_positive], "n": [n]}
        )

    codes, labels, n = [], [], 0
    for batch in batches:
        y = batch["y"].to_numpy(zero_copy_only=False)
        if not np.isin(y, (0.0, 1.0)).all():
            raise ValueError("labels must be 0 or 1")
        codes.append(encode(_matrix(batch["x"]), bins))
        labels.append(y)
        n += len(y)
        if n >= BLOCK_ROWS:
            yield stored(_block(codes, labels), n)
            codes, labels, n = [], [], 0
    if n:
        yield stored(_block(codes, labels), n)


def _loaded(row, sizes: list[int]) -> tuple[Block, int]:
    codes = [np.frombuffer(c, np.uint16 if size <= 2**16 else np.int64) for c, size in zip(row.codes, sizes)]
    return Block(codes, row.n_positive), row.n


def _one_by_one(rdd: RDD) -> RDD:
    """Elements stored one by one, so that two tables of equal blocks can be read side by side."""
    return rdd._reserialize(BatchedSerializer(CPickleSerializer(), 1)).persist(StorageLevel.MEMORY_AND_DISK)


# -- passes over blocks --------------------------------------------------------------------


def _rows_of(block: Block, tests: dict[int, tuple[int, np.ndarray]], wanted: Iterable[int]) -> dict[int, np.ndarray]:
    """The rows of some nodes. ``tests``: the code that a node asks for, and the outcomes that go left."""
    path = {k >> up for k in wanted for up in range(k.bit_length())}
    rows: dict[int, np.ndarray] = {}
    for k in sorted(path):
        if k == 1:
            continue
        code, left = tests[k >> 1]
        above = rows.get(k >> 1)
        if k & 1 and k - 1 in path:
            continue  # both sides were told apart at once
        goes_left = left.take(block.codes[code] if above is None else block.codes[code].take(above))
        for side in {k, k ^ 1} & path:
            took = goes_left if side & 1 == 0 else ~goes_left
            rows[side] = np.flatnonzero(took) if above is None else above[took]
    return {k: rows.get(k) for k in wanted}


def _targets(block: Block, n: int, margins: np.ndarray | None) -> np.ndarray:
    """What a tree is fitted to: the labels -1 and 1, later the negative gradient 4 y / (1 + exp(2 y margin))."""
    if margins is None:
        out = np.full(n, -1.0)
        out[: block.n_positive] = 1.0
        return out
    with np.errstate(over="ignore"):
        signed = 2.0 * margins
        np.negative(signed[block.n_positive :], out=signed[block.n_positive :])
        out = 4.0 / (1.0 + np.exp(signed, out=signed))
    np.negative(out[block.n_positive :], out=out[block.n_positive :])
    return out


def _unpacked(counts: np.ndarray, bins: Bins, g: int, out: np.ndarray) -> None:
    """Counts per outcome of a code as counts per bin of its features."""
    for f, stride in bins.groups[g]:
        n = len(bins.thresholds[f]) + 1
        out[:, f, :n] += counts.reshape(len(counts), -1, n, stride).sum(axis=(1, 3))


class _Counts:
    """For each wanted node its rows, its defaults and its weighted targets per outcome of every code, and its squares.

    Without ``with_rows`` targets and squares alone: the rows of the root are the same in every round.
    """

    def __init__(self, bins: Bins, positive: float, wanted: Iterable[int], with_rows: bool = True):
        self.bins, self.positive, self.with_rows = bins, positive, with_rows
        self.sums = {k: [np.zeros((3, size)) for size in bins.sizes] for k in wanted}
        self.squares = dict.fromkeys(wanted, 0.0)

    def add(self, block: Block, targets: np.ndarray, nodes: dict[int, np.ndarray | None]) -> None:
        weighted = targets.copy()
        weighted[: block.n_positive] *= self.positive
        for k, at in nodes.items():
            own = weighted if at is None else weighted.take(at)
            n_positive = block.n_positive if at is None else int(np.searchsorted(at, block.n_positive))
            self.squares[k] += float(own @ (targets if at is None else targets.take(at)))
            for codes, size, (rows, defaults, total) in zip(block.codes, self.bins.sizes, self.sums[k]):
                code = (codes if at is None else codes.take(at)).astype(np.intp)
                total += np.bincount(code, weights=own, minlength=size)
                if self.with_rows:
                    rows += np.bincount(code, minlength=size)
                    defaults += np.bincount(code[:n_positive], minlength=size)

    def found(self) -> dict[int, tuple[np.ndarray, float]]:
        """The counts per feature and bin."""
        found = {}
        for k, sums in self.sums.items():
            out = np.zeros((3, len(self.bins.thresholds), self.bins.width))
            for g, counts in enumerate(sums):
                _unpacked(counts, self.bins, g, out)
            found[k] = (out, self.squares[k])
        return found


def _counted(blocks: Iterable, bins: Bins, positive: float, tests: dict, wanted: list[int]) -> Iterator[dict]:
    counts = _Counts(bins, positive, wanted)
    for (block, n), stored in blocks:
        counts.add(block, _targets(block, n, stored and stored[0]), _rows_of(block, tests, wanted))
    yield counts.found()


def _moved(blocks: Iterable, bins: Bins, positive: float, tests: dict, leaves: dict[int, float], weight: float) -> Iterator[tuple]:
    """The margins of each block after one more tree; the last one of a task has the root's counts for the next tree."""
    counts, done = _Counts(bins, positive, [1], with_rows=False), None
    for (block, n), stored in blocks:
        if done is not None:
            yield done, None
        done = np.zeros(n) if stored is None else stored[0].copy()
        for k, at in _rows_of(block, tests, list(leaves)).items():
            if at is None:
                done += weight * leaves[k]
            else:
                done[at] += weight * leaves[k]
        counts.add(block, _targets(block, n, done), {1: None})
    if done is not None:
        yield done, counts.found()


def _added(a: dict, b: dict) -> dict:
    return {k: (a[k][0] + b[k][0], a[k][1] + b[k][1]) for k in a}


# -- growing -------------------------------------------------------------------------------


def best_split(counts: np.ndarray, positive: float, squares: float, bins: Bins) -> tuple[Split, Node, Node] | None:
    """The split with the largest gain and its two sides; None where no split gains anything."""
    rows, defaults, total = np.cumsum(counts, axis=2)
    weight = rows + (positive - 1.0) * defaults
    n, w, s = rows[:, -1:], weight[:, -1:], total[:, -1:]
    splits = np.array([len(t) for t in bins.thresholds])
    valid = (np.arange(bins.width) < splits[:, None]) & (rows > 0) & (rows < n)
    if not valid.any():
        return None
    with np.errstate(divide="ignore", invalid="ignore"):
        between = total**2 / weight + (s - total) ** 2 / (w - weight) - s**2 / w
        gain = np.where(valid, between / w, -np.inf)
    best = gain.max()
    at_all = float(w[splits > 0][0, 0])
    if best <= NOISE * squares / at_all:
        return None
    f, b = (int(i) for i in np.argwhere(gain >= best * (1 - TIE))[0])
    left = Node(float(weight[f, b]), float(total[f, b]), round(float(rows[f, b])))
    right = Node(float(w[f, 0] - weight[f, b]), float(s[f, 0] - total[f, b]), round(float(n[f, 0] - rows[f, b])))
    return Split(f, b, float(best)), left, right


def grow(count: Callable[[dict, list[int]], dict], bins: Bins, positive: float, depth: int) -> tuple[Tree, dict]:
    """One tree, level by level, and its tests. ``count`` gives the counts of some nodes below the tests so far."""
    tree, tests = Tree({}, {}, {}), {}
    wanted, counts = [1], {}
    for level in range(depth):
        fresh = count(tests, wanted)
        above, counts = counts, {}
        for k, (own, squares) in fresh.items():
            counts[k], tree.squares[k] = own, squares
            if k > 1:
                rest = above[k >> 1] - own
                rest[2][rest[0] == 0] = 0.0
                counts[k ^ 1], tree.squares[k ^ 1] = rest, max(0.0, tree.squares[k >> 1] - squares)
        wanted = []
        for k in sorted(counts):
            if k == 1:
                rows, defaults, total = counts[k][:, max(range(len(bins.thresholds)), key=lambda f: len(bins.thresholds[f]))].sum(axis=1)
                tree.nodes[k] = Node(float(rows + (positive - 1.0) * defaults), float(total), round(float(rows)))
            own = tree.nodes[k]
            spread = tree.squares[k] - own.total**2 / own.weight
            best = None if spread <= NOISE * tree.squares[k] else best_split(counts[k], positive, tree.squares[k], bins)
            if best is None:
                continue
            tree.splits[k], tree.nodes[2 * k], tree.nodes[2 * k + 1] = best
            code, own_bins = bins.place(best[0].feature)
            tests[k] = (code, own_bins <= best[0].bin)
            wanted.append(2 * k if best[1].rows <= best[2].rows else 2 * k + 1)
        if not wanted:
            break
    return tree, tests


def _leaves(tree: Tree) -> dict[int, float]:
    return {k: n.total / n.weight for k, n in tree.nodes.items() if k not in tree.splits}


def boost(
    rows: DataFrame, n: int, weight: float, positive: float, rounds: int, depth: int, rate: float, seed: int,
    max_bins: int = 32, checkpoint_rounds: int = 10,
) -> tuple[list[Tree], Bins]:
    """The trees for ``rows`` (vector ``x``, label ``y`` of 0 or 1): ``n`` of them, of ``weight`` together, defaults
    counting ``positive`` times."""
    spark = rows.sparkSession
    bins = find_bins(rows, n, weight, positive, max_bins, seed)
    stored = rows.select(vector_to_array("x").alias("x"), "y").mapInArrow(
        lambda batches: _stored_blocks(batches, bins), "codes array<binary>, n_positive long, n long"
    )
    sizes = bins.sizes
    blocks = _one_by_one(stored.rdd.map(lambda row: _loaded(row, sizes)))
    _allow_checkpoints(spark)
    margins: RDD | None = None
    before: RDD | None = None
    folder, trees = None, []

    def side_by_side() -> RDD:
        return blocks.map(lambda b: (b, None)) if margins is None else blocks.zip(margins)

    root: np.ndarray | None = None

    def count(tests: dict, wanted: list[int]) -> dict:
        nonlocal root
        if margins is not None and wanted == [1]:
            found = _total(margins.flatMap(lambda stored: [] if stored[1] is None else [stored[1]]))
            found[1][0][:2] = root
            return found
        found = _total(side_by_side().mapPartitions(lambda b: _counted(b, bins, positive, tests, wanted)))
        if wanted == [1]:
            root = found[1][0][:2].copy()
        return found

    for k in range(rounds):
        tree, tests = grow(count, bins, positive, depth)
        trees.append(tree)
        # The first count has stored the margins, and every few rounds a copy that ends their lineage.
        if before is not None:
            before.unpersist()
        if margins is not None and (stored_at := margins.getCheckpointFile()) is not None:
            if folder is not None:
                delete_folder(spark, folder)
            folder = stored_at
        if k == rounds - 1:
            break
        moved = _one_by_one(_after(side_by_side(), bins, positive, tests, _leaves(tree), 1.0 if k == 0 else rate))
        if (k + 1) % checkpoint_rounds == 0:
            moved.checkpoint()
        before, margins = margins, moved
    for rdd in (blocks, margins):
        if rdd is not None:
            rdd.unpersist()
    if folder is not None:
        delete_folder(spark, folder)
    return trees, bins


def _after(blocks: RDD, bins: Bins, positive: float, tests: dict, leaves: dict[int, float], weight: float) -> RDD:
    return blocks.mapPartitions(lambda b: _moved(b, bins, positive, tests, leaves, weight))


def _total(parts: RDD) -> dict:
    if parts.getNumPartitions() > DIRECT_TASKS:
        return parts.treeReduce(_added)
    return reduce(_added, parts.collect())


def _allow_checkpoints(spark: SparkSession) -> None:
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark, "margins"))


# -- the fitted model ----------------------------------------------------------------------

_TREE_PARAMS = (
    "cacheNodeIds", "checkpointInterval", "featuresCol", "impurity", "labelCol", "leafCol", "maxBins", "maxDepth",
    "maxMemoryInMB", "minInfoGain", "minInstancesPerNode", "minWeightFractionPerNode", "predictionCol", "seed", "weightCol",
)


def fit(estimator: GBTClassifier, rows: DataFrame, n: int, weight: float, positive: float) -> GBTClassificationModel:
    """``estimator.fit`` for labels 0 and 1 and a weight of ``positive`` for each default."""
    vectors = rows.select(F.col(estimator.getFeaturesCol()).alias("x"), F.col(estimator.getLabelCol()).cast("double").alias("y"))
    trees, bins = boost(
        vectors, n, weight, positive, estimator.getMaxIter(), estimator.getMaxDepth(), estimator.getStepSize(),
        estimator.getSeed(), estimator.getMaxBins(), estimator.getCheckpointInterval(),
    )
    return as_model(rows.sparkSession, estimator, trees, bins)


def as_model(spark: SparkSession, estimator: GBTClassifier, trees: list[Tree], bins: Bins) -> GBTClassificationModel:
    """The trees as MLlib's model, through the format in which MLlib stores one."""
    folder = shared_folder(spark, "boosted")
    estimator.save(f"{folder}/estimator")
    told = json.loads(spark.read.text(f"{folder}/estimator/metadata").first().value)
    told |= {"class": "org.apache.spark.ml.classification.GBTClassificationModel", "uid": f"GBTClassifier_{uuid.uuid4().hex[:12]}"}
    params = {kind: {p: v for p, v in told[kind].items() if p in _TREE_PARAMS} for kind in ("paramMap", "defaultParamMap")}
    tree_class = {"class": "org.apache.spark.ml.regression.DecisionTreeRegressionModel"}
    each = [
        (k, json.dumps(told | params | tree_class | {"uid": f"dtr_{uuid.uuid4().hex[:12]}"}), 1.0 if k == 0 else estimator.getStepSize())
        for k in range(len(trees))
    ]
    whole = json.dumps(told | {"numFeatures": len(bins.thresholds), "numTrees": len(trees)})
    nodes = [(k, node) for k, tree in enumerate(trees) for node in _stored_nodes(tree, bins)]
    spark.createDataFrame([(whole,)], "value string").coalesce(1).write.text(f"{folder}/model/metadata")
    spark.createDataFrame(each, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{folder}/model/treesMetadata")
    spark.createDataFrame(nodes, _NODES).coalesce(1).write.parquet(f"{folder}/model/data")
    return GBTClassificationModel.load(f"{folder}/model")


_NODES = (
    "treeID int, nodeData struct<id int, prediction double, impurity double, impurityStats array<double>, rawCount long,"
    " gain double, leftChild int, rightChild int,"
    " split struct<featureIndex int, leftCategoriesOrThreshold array<double>, numCategories int>>"
)


def _stored_nodes(tree: Tree, bins: Bins) -> list[tuple]:
    """Nodes in preorder; siblings that are leaves of the same value are one leaf.

    The squares of the leaves of the lowest level are not counted; they and their impurity are NaN.
    """
    kept = dict(tree.splits)
    for k in sorted(tree.splits, reverse=True):
        left, right = tree.nodes[2 * k], tree.nodes[2 * k + 1]
        if 2 * k not in kept and 2 * k + 1 not in kept and left.total / left.weight == right.total / right.weight:
            del kept[k]
    found: list[tuple] = []

    def add(k: int) -> int:
        at, node = len(found), tree.nodes[k]
        mean, squares = node.total / node.weight, tree.squares.get(k, math.nan)
        stats = (mean, squares / node.weight - mean**2, [node.weight, node.total, squares], node.rows)
        found.append(())
        if k in kept:
            split = kept[k]
            threshold = float(bins.thresholds[split.feature][split.bin])
            ends = (split.gain, add(2 * k), add(2 * k + 1), (split.feature, [threshold], -1))
        else:
            ends = (-1.0, -1, -1, (-1, [], -1))
        found[at] = (at, *stats, *ends)
        return at

    add(1)
    return found
