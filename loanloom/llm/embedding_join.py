"""Embedding near-duplicates by an epsilon grid order join."""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt, sqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.shared import materialise
from .components import components, join_local

#: A pair is left out by its leading dimensions only if its cosine must be below the bound by more than this.
MARGIN = 1e-4
#: Rows of one side below which an interval is not halved any more.
LEAF = 512


def _matrix(vectors: pa.Array, dims: int) -> np.ndarray:
    """Unit vectors as rows; the largest component is brought to one first, so that squares stay in range."""
    x = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def linkable(rows: DataFrame) -> DataFrame:
    """``vector, n, size`` of the distinct vectors that can link: not null, not zero, all components finite."""
    size = F.when(F.col("vector").isNull(), 0).otherwise(F.size("vector"))
    distinct = rows.groupBy("vector").agg(F.count("*").alias("n"), size.alias("size"))

    def finite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch["size"].to_numpy(zero_copy_only=False)
            x = batch["vector"].flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            row = np.repeat(np.arange(len(sizes)), sizes)
            odd = np.bincount(row, ~np.isfinite(x), len(sizes))  # a null component reads as not a number
            some = np.bincount(row, x != 0, len(sizes))
            yield batch.filter(pa.array((odd == 0) & (some > 0)))

    return distinct.mapInArrow(finite, distinct.schema)


def principal_axes(units: DataFrame, dims: int) -> np.ndarray:
    """Axes as columns, the one of the greatest variance first; 1 + d + d*d numbers reach the driver."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, first, second = 0, np.zeros(dims), np.zeros((dims, dims))
        for batch in batches:
            x = _matrix(batch["vector"], dims)
            n, first, second = n + len(x), first + x.sum(axis=0), second + x.T @ x
        values = np.concatenate(([float(n)], first, second.ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values))), pa.array(values)], ["at", "x"])

    parts = units.select("vector").mapInArrow(sums, "at long, x double")
    total = {r["at"]: r["x"] for r in parts.groupBy("at").agg(F.sum("x").alias("x")).collect()}
    values = np.array([total.get(i, 0.0) for i in range(1 + dims + dims * dims)])
    if not values[0]:
        return np.eye(dims)
    mean, second = values[1 : dims + 1] / values[0], values[dims + 1 :].reshape(dims, dims) / values[0]
    return np.linalg.eigh(second - np.outer(mean, mean))[1][:, ::-1]


def in_grid_order(units: DataFrame, axes: np.ndarray, reach: float, names: list[str]) -> DataFrame:
    """``node, n, vector`` and, under ``names``, the grid cells of the unit vector on the leading axes."""
    dims = len(axes)
    rows = units.select("node", "n", "vector")

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = np.floor(_matrix(batch["vector"], dims) @ axes[:, : len(names)] / reach).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *[pa.array(np.ascontiguousarray(c)) for c in cell.T]], [*batch.schema.names, *names]
            )

    kinds = T.StructType([*rows.schema.fields, *[T.StructField(c, T.IntegerType()) for c in names]])
    return rows.mapInArrow(cells, kinds)


def cut_intervals(ordered: DataFrame, axes: np.ndarray, interval_rows: int) -> DataFrame:
    """Stretches of up to ``interval_rows`` rows of each sorted partition, one row each, with their boxes.

    Vectors are kept as they were given.
    """
    dims = len(axes)
    element = ordered.schema["vector"].dataType.elementType

    def interval(held: list[pa.RecordBatch], part: int, chunk: int) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks()
        vectors = rows["vector"].chunk(0)
        x = _matrix(vectors, dims) @ axes
        listed = {
            "nodes": rows["node"].chunk(0),
            "weights": rows["n"].chunk(0),
            "values": vectors.flatten(),
            "low": pa.array(x.min(axis=0)),
            "high": pa.array(x.max(axis=0)),
        }
        cell = rows["c0"].to_numpy()
        one = {
            "interval": (part << 32) + chunk,
            "size": len(rows),
            "first_cell": int(cell.min()),
            "last_cell": int(cell.max()),
        }
        arrays = [pa.array([v], pa.int32() if "cell" in k else pa.int64()) for k, v in one.items()]
        arrays += [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for v in listed.values()]
        return pa.RecordBatch.from_arrays(arrays, [*one, *listed])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, chunk, held, size = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                held.append(batch.slice(at, interval_rows - size))
                at, size = at + held[-1].num_rows, size + held[-1].num_rows
                if size == interval_rows:
                    yield interval(held, part, chunk)
                    chunk, held, size = chunk + 1, [], 0
        if size:
            yield interval(held, part, chunk)

    kinds = (
        "interval long, size long, first_cell int, last_cell int, nodes array<long>, weights array<long>, "
        f"values array<{element.simpleString()}>, low array<double>, high array<double>"
    )
    return ordered.select("node", "n", "vector", "c0").mapInArrow(cut, kinds)


class Interval:
    """A stretch of the sequence: places, their boxes on all axes, and what a pair's leading axes can prove."""

    def __init__(self, places: np.ndarray, weights: np.ndarray, lead: int):
        self.places, self.weights = places, weights
        rest = np.sqrt(np.maximum(0.0, 1.0 - (places[:, :lead] ** 2).sum(axis=1)))
        self.short = np.hstack((places[:, :lead], rest[:, None])).astype(np.float32)
        self.boxes: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    def box(self, rows: slice) -> tuple[np.ndarray, np.ndarray]:
        key = (rows.start, rows.stop)
        if key not in self.boxes:
            self.boxes[key] = self.places[rows].min(axis=0), self.places[rows].max(axis=0)
        return self.boxes[key]


def _distant(a: Interval, ra: slice, b: Interval, rb: slice, reach: float) -> bool:
    (low_a, high_a), (low_b, high_b) = a.box(ra), b.box(rb)
    gap = np.maximum(0.0, np.maximum(low_a - high_b, low_b - high_a))
    return float(gap @ gap) > (reach + MARGIN) ** 2


def join_intervals(a: Interval, b: Interval, cosine: float, reach: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Linked weight of each row of ``a`` and of ``b``, and component labels over the rows of both.

    Intervals are halved, the longer first, unless their boxes are farther apart than ``reach``; short ones are
    compared. There the leading axes and the length of the rest bound the cosine of a pair (in single precision,
    with a margin); pairs that may link are computed from whole vectors in double precision.
    """
    same = a is b
    weight_a, weight_b = np.zeros(len(a.places), np.int64), np.zeros(len(b.places), np.int64)
    n = len(a.places) + (0 if same else len(b.places))
    lefts, rights, held = [], [], 0
    todo = [(slice(0, len(a.places)), slice(0, len(b.places)))]
    while todo:
        ra, rb = todo.pop()
        if same and rb.stop <= ra.start:  # the mirror image of a part that is compared
            continue
        if _distant(a, ra, b, rb, reach):
            continue
        na, nb = ra.stop - ra.start, rb.stop - rb.start
        if max(na, nb) > LEAF:
            if na >= nb:
                mid = ra.start + na // 2
                todo += [(slice(ra.start, mid), rb), (slice(mid, ra.stop), rb)]
            else:
                mid = rb.start + nb // 2
                todo += [(ra, slice(rb.start, mid)), (ra, slice(mid, rb.stop))]
            continue
        i, j = np.nonzero(a.short[ra] @ b.short[rb].T >= cosine - MARGIN)
        i, j = i + ra.start, j + rb.start
        if same:
            i, j = i[i < j], j[i < j]
        linked = np.empty(len(i), bool)
        for at in range(0, len(i), 65_536):
            part = slice(at, at + 65_536)
            linked[part] = np.einsum("ij,ij->i", a.places[i[part]], b.places[j[part]]) >= cosine
        i, j = i[linked], j[linked]
        np.add.at(weight_a, i, b.weights[j])
        np.add.at(weight_b, j, a.weights[i])
        lefts.append(i)
        rights.append(j if same else j + len(a.places))
        held += len(i)
        if held > 1_000_000:
            label = join_local(np.concatenate(lefts), np.concatenate(rights), n)
            moved = np.flatnonzero(label != np.arange(n))
            lefts, rights, held = [moved], [label[moved]], len(moved)
    none = np.empty(0, np.int64)
    label = join_local(np.concatenate([none, *lefts]), np.concatenate([none, *rights]), n)
    return weight_a, weight_b, label


def join_blocks(rows: pa.Table, axes: np.ndarray, cosine: float, reach: float, lead: int) -> pa.Table:
    """``node, weight, tree`` of the linked rows of two blocks or of one: linked weight and a spanning forest."""
    dims = len(axes)
    rows = rows.sort_by("interval")

    def whole(block: str) -> tuple[Interval, np.ndarray]:
        of = rows.filter(pc.equal(rows["block"], rows[block][0])).combine_chunks()
        vectors, weights, nodes = (of[c].chunk(0) for c in ("values", "weights", "nodes"))
        vectors = pa.FixedSizeListArray.from_arrays(vectors.flatten(), dims)
        return Interval(_matrix(vectors, dims) @ axes, weights.flatten().to_numpy(), lead), nodes.flatten().to_numpy()

    a, nodes = whole("p")
    if rows["p"][0] == rows["q"][0]:
        weight_a, weight_b, label = join_intervals(a, a, cosine, reach)
        weight = weight_a + weight_b
    else:
        b, others = whole("q")
        weight_a, weight_b, label = join_intervals(a, b, cosine, reach)
        weight, nodes = np.concatenate((weight_a, weight_b)), np.concatenate((nodes, others))
    hit = np.flatnonzero(weight)
    return pa.table({"node": nodes[hit], "weight": weight[hit], "tree": nodes[label[hit]]})


def near_vectors(
    rows: DataFrame, cosine: float = 0.9, id_col: str = "vec_id", vector: str = "embedding",
    interval_rows: int = 4096, order_dims: int = 8, lead: int = 24, max_block: int = 8, max_tasks: int = 20_000,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row of ``rows``.

    Cosine >= c is distance <= sqrt(2 - 2c) between unit vectors. Distinct unit vectors are turned to their
    principal axes (a distance keeps its length), sorted by their grid cells of that width on the leading axes,
    and cut into intervals; every pair of intervals whose boxes are within reach is joined recursively. Equal
    vectors are one node with a weight, and a pair of blocks gives sums of weights and a spanning forest, so
    no group of copies is expanded into pairs. Intervals hold ``interval_rows`` rows whatever the data. They are
    dealt out in pairs of blocks of neighbours, so an interval is copied once per block in reach, not once per
    interval; a block has the rows of about the square root of the number of intervals, of ``max_block`` at most.

    A vector that is null, zero, of another length than most or with null or non-finite components links with
    nothing and is its own component. A null id keeps its row and counts as a link of others, but names no
    component. An empty table gives an empty result.
    """
    reach = sqrt(2 - 2 * cosine)
    given = rows.select(F.col(id_col).alias("id"), F.col(vector).alias("vector"))
    if not isinstance(given.schema["vector"].dataType.elementType, (T.FloatType, T.DoubleType)):
        given = given.withColumn("vector", F.col("vector").cast("array<double>"))
    units = materialise(linkable(given).withColumn("node", F.monotonically_increasing_id()))
    sizes = units.groupBy("size").agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "size").first()
    dims = sizes["size"] if sizes else 1
    units = units.filter(F.col("size") == dims)
    axes = principal_axes(units, dims)
    lead = min(lead, dims)
    names = [f"c{k}" for k in range(min(order_dims, dims))]
    intervals = max(1, -(-(sizes["rows"] if sizes else 0) // interval_rows))
    block_rows = interval_rows * min(max_block, isqrt(intervals))
    keyed = in_grid_order(units, axes, reach, names)
    ranged = keyed.repartitionByRange(intervals, *names, "node").sortWithinPartitions(*names, "node")
    grouped = materialise(cut_intervals(ranged, axes, interval_rows))
    # Only intervals in the same or adjoining cells of the first axis can be within reach; there are few cells,
    # since unit vectors lie between -1 and 1.
    before = F.sum("size").over(Window.orderBy("interval")) - F.col("size")  # a row for each interval
    boxes = grouped.drop("nodes", "weights", "values").withColumn("block", F.floor(before / block_rows))
    boxes = materialise(boxes.drop("size"))
    partner = boxes.select(*[F.col(c).alias(f"{c}_b") for c in boxes.columns])
    here = boxes.withColumn("cell", F.explode(F.sequence("first_cell", "last_cell")))
    there = partner.withColumn("cell", F.explode(F.sequence(F.col("first_cell_b") - 1, F.col("last_cell_b") + 1)))
    gap = F.aggregate(
        F.arrays_zip("low", "high", "low_b", "high_b"),
        F.lit(0.0),
        lambda s, g: s + F.pow(F.greatest(F.lit(0.0), g["low"] - g["high_b"], g["low_b"] - g["high"]), F.lit(2)),
    )
    near = here.join(there, "cell").filter("interval <= interval_b").filter(gap <= (reach + MARGIN) ** 2)
    near = near.select(F.col("block").alias("p"), F.col("block_b").alias("q"), F.array("interval", "interval_b").alias("both"), F.array("block", "block_b").alias("blocks"))
    sides = F.explode(F.arrays_zip("both", "blocks"))
    wanted = near.select("p", "q", sides.alias("s")).select("p", "q", "s.blocks", "s.both").distinct()
    wanted = materialise(wanted.toDF("p", "q", "block", "interval"))
    # As many tasks as pairs of blocks: their work is in comparing, which sizes in bytes don't tell.
    tasks = min(max_tasks, max(1, wanted.select("p", "q").distinct().count()))
    met = wanted.join(grouped.select("interval", "nodes", "weights", "values"), "interval")
    hits = materialise(
        met.repartition(tasks, "p", "q")
        .groupBy("p", "q")
        .applyInArrow(lambda rows: join_blocks(rows, axes, cosine, reach, lead), "node long, weight long, tree long")
    )
    weights = hits.groupBy("node").agg(F.sum("weight").alias("weight"))
    roots = components(hits.select(F.col("node").alias("a"), F.col("tree").alias("b")))
    known = materialise(
        units.select("vector", "node", "n")
        .join(weights, "node", "left")
        .join(roots, "node", "left")
        .select(
            "vector",
            (F.coalesce("weight", F.lit(0)) + F.col("n") - 1).alias("n_links"),
            F.coalesce("root", "node").alias("root"),
        )
    )
    labelled = materialise(given.join(known, "vector", "left").select("id", "n_links", "root"))
    smallest = materialise(labelled.filter("root IS NOT NULL").groupBy("root").agg(F.min("id").alias("least")))
    out = labelled.join(smallest, "root", "left").select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("least", "id").alias("component_id"),
    )
    return out.withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(False)))

