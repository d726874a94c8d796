"""Merkle manifest of a dataset: leaves per source, trees of fixed fan-out, proofs and their verification.

The nodes of a level are numbered within their source; ``slot = place % fan_out`` and ``run = place / fan_out``. Lag
and lead columns of the offsets 1 to ``fan_out - 1``, masked by slot and by the length of the run, give each node
its siblings, and the first child of a run hashes the parent. The roots of the sources are the leaves of a last
tree. Going down again, every node gets the siblings of all levels above it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.shared import materialise
from .common import ascii_lower

FAN_OUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_PATH = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    """H: lowercase hex SHA-256 of the parts one after another."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A value with its length in bytes, so that no two rows are spelled alike; ``-`` is null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(**values: Column) -> Column:
    return digest(*[field(values[name]) for name in FIELDS])


def tampered_text(doc_id: Column, text: Column, rate: int) -> Column:
    """The text as it is found later: A-Z lowered where ``rate`` divides the check sum of the id."""
    return F.when(F.crc32(doc_id.cast("string")) % rate == 0, ascii_lower(text)).otherwise(text)


def place_within(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``place`` (0, 1, ... within the group, by ``order``) and ``size`` (rows of the group).

    Rows are dealt to ranges of (group, order), so that a group with a third of all rows lies in many tasks; places
    are numbers inside a range plus what earlier ranges hold. ``order`` has to be unique within a group.
    """
    keys = [group, *order]
    ranged = materialise(
        rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select(
            "*", F.spark_partition_id().alias("range"), F.monotonically_increasing_id().alias("number")
        )
    )
    held = materialise(ranged.groupBy(group, "range").agg(F.min("number").alias("first"), F.count("*").alias("held")))
    before = F.sum("held").over(Window.partitionBy(group).orderBy("range")) - F.col("held")
    total = F.sum("held").over(Window.partitionBy(group))
    offsets = materialise(held.select(group, "range", (before - F.col("first")).alias("shift"), total.alias("size")))
    return ranged.join(offsets, [group, "range"]).select(
        *rows.columns, (F.col("number") + F.col("shift")).alias("place"), "size"
    )


def _with_siblings(nodes: DataFrame, fan_out: int) -> DataFrame:
    """``nodes`` (``tree, place, size, node``) with ``run``, ``slot`` and the siblings ``left`` and ``right``.

    A node that is its whole level has no siblings.
    """
    placed = nodes.withColumns(
        {"run": F.expr(f"place div {fan_out}"), "slot": (F.col("place") % fan_out).cast("int")}
    ).withColumn("run_size", F.least(F.lit(fan_out), F.col("size") - F.col("run") * fan_out).cast("int"))
    window = Window.partitionBy("tree", "run").orderBy("place")
    empty = F.lit("")
    lags = [F.when(F.col("slot") >= k, F.lag("node", k).over(window)) for k in range(fan_out - 1, 0, -1)]
    leads = [F.when(F.col("slot") + k < F.col("run_size"), F.lead("node", k).over(window)) for k in range(1, fan_out)]
    return placed.withColumns(
        {
            "left": F.concat(*[F.coalesce(x, empty) for x in lags]),
            "right": F.concat(*[F.coalesce(x, empty) for x in leads]),
        }
    )


def _parents(nodes: DataFrame, fan_out: int) -> DataFrame:
    """The next level: first children hash their run; a node that is its whole level stays as it is."""
    first = _with_siblings(nodes, fan_out).filter("slot = 0")
    parent = F.when(F.col("size") == 1, F.col("node")).otherwise(digest(F.col("node"), F.col("right")))
    return first.select(
        "tree", F.col("run").alias("place"), F.expr(f"(size + {fan_out - 1}) div {fan_out}").alias("size"), parent.alias("node")
    )


def _levels(leaves: DataFrame, fan_out: int) -> list[DataFrame]:
    """The levels of all trees from the leaves up, until each tree is one node; all but the first are stored."""
    levels, most = [leaves], leaves.agg(F.max("size")).first()[0] or 1
    while most > 1:
        levels.append(materialise(_parents(levels[-1], fan_out)))
        most = -(-most // fan_out)
    return levels


def _descend(nodes: DataFrame, above: DataFrame, fan_out: int) -> DataFrame:
    """``nodes`` with ``path``, the siblings on every level from the node's own up to the root, and ``subroot``.

    ``above`` has both of the next level. They meet on (tree, run), which the windows are dealt by as well.
    """
    upper = above.select("tree", F.col("place").alias("run"), F.col("path").alias("upper"), "subroot")
    own = F.array(F.struct("left", "right")).cast(_PATH)
    path = F.when(F.col("size") == 1, F.col("upper")).otherwise(F.concat(own, F.col("upper")))
    return _with_siblings(nodes, fan_out).join(upper, ["tree", "run"]).select(*nodes.columns, path.alias("path"), "subroot")


def _paths(levels: list[DataFrame], top: DataFrame, fan_out: int) -> DataFrame:
    """The lowest level with its paths; ``top`` (``tree, place, path, subroot``) has those of the trees' roots."""
    for k in range(len(levels) - 2, -1, -1):
        top = _descend(levels[k], top, fan_out)
        top = materialise(top) if k else top
    return top


def fold(node: Column, path: Column) -> Column:
    """The root that a node and its siblings on every level lead to."""
    return F.aggregate(path, node, lambda below, at: digest(at["left"], below, at["right"]))


def proof_digest(path: Column) -> Column:
    """H of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda at: F.concat(at["left"], at["right"])), ""), 256)


def manifest(docs: DataFrame, rate: int = 5, fan_out: int = FAN_OUT) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of every row of ``docs``.

    A leaf is the hash of a row's ``FIELDS``; per source (null is one, and the first) leaves ascend by doc_id, null
    ids first, rows of one id by their leaf, equal rows in any order. Every ``fan_out`` consecutive nodes become one, the last run may be
    shorter, even a single node; a lone leaf is its source's root. ``folded_root`` is recomputed from the row as it
    is found later and the stored siblings; ``verified`` says whether it is the root. An empty table gives an empty
    result; other columns are left out.

    Texts are read once and never shuffled: from there on rows have two digests. A source of any size lies in many
    tasks; windows hold one run.
    """
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *FIELDS[1:])
    values = {name: F.col(name) for name in FIELDS}
    later = tampered_text(values["doc_id"], values["text"], rate)
    leaf = leaf_of(**values)
    hashed = materialise(
        found.select(
            "doc_id",
            F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("tree"),  # null sorts first
            leaf.alias("node"),
            F.when(later == F.col("text"), F.lit(None)).otherwise(leaf_of(**values | {"text": later})).alias("other"),
            F.monotonically_increasing_id().alias("row"),
        )
    )
    leaves = materialise(place_within(hashed, "tree", ["doc_id", "node", "row"]))
    levels = _levels(leaves.select("doc_id", "tree", "place", "size", "node", "other"), fan_out)

    subroots = levels[-1].select(F.lit("").alias("group"), F.col("tree").alias("source"), F.col("node"))
    placed = materialise(place_within(subroots, "group", ["source"]))
    crown = _levels(placed.select(F.col("group").alias("tree"), "place", "size", "node", "source"), fan_out)
    root = crown[-1].first()
    no_path = F.array().cast(_PATH).alias("path")
    above = _paths(crown, crown[-1].select("*", no_path, F.lit(None).cast("string").alias("subroot")), fan_out)
    top = above.select(F.col("source").alias("tree"), "path", F.col("node").alias("subroot"))

    proven = _paths(levels, materialise(levels[-1].join(top, "tree")), fan_out)
    fresh = F.coalesce("other", "node")
    return proven.select(
        "doc_id", F.col("node").alias("leaf"), "subroot", F.lit(root and root["node"]).cast("string").alias("root"),
        proof_digest(F.col("path")).alias("proof_sha256"), fold(fresh, F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
