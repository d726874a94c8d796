"""Tables along a space-filling curve."""

from __future__ import annotations

import glob
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from loanloom.operators import portfolio
from loanloom.sources import layout

SCHEMA = "loan_id long, grade string, purpose string, recommended_action string, __n long"
COLUMNS = portfolio.FILTER_COLUMNS


def loans(n: int, hot: float = 0.0) -> list[tuple]:
    draw = random.Random(4)
    rows = []
    for i in range(n):
        grade, purpose, tier = draw.choice("ABCDEFG"), f"p{draw.randrange(9)}", draw.choice("wxyz")
        rows.append((i, "C", "p5", "x", i) if draw.random() < hot else (i, grade, purpose, tier, i))
    return rows


def row_groups_read(path: str, column: str, value: str) -> tuple[int, int]:
    """Row groups whose own statistics admit the value, and all of them."""
    admitted = total = 0
    for name in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(name).metadata
        at = meta.schema.names.index(column)
        for g in range(meta.num_row_groups):
            stats = meta.row_group(g).column(at).statistics
            total += 1
            admitted += stats.has_min_max and stats.min <= value <= stats.max
    return admitted, total


def test_each_single_filter_skips_half_the_row_groups(spark, tmp_path):
    rows, path = loans(6000), str(tmp_path / "t")
    layout.write_clustered(spark.createDataFrame(rows, SCHEMA), path, COLUMNS, "loan_id", 64)
    stored = spark.read.parquet(path)
    assert stored.columns == [c.split()[0] for c in SCHEMA.split(", ")]
    assert sorted(map(tuple, stored.collect())) == rows
    seen = {(r.name, r.value): r for r in layout.files_admitted(stored, COLUMNS).collect()}
    for k, column in enumerate(COLUMNS, 1):
        for value in {r[k] for r in rows}:
            admitted, total = row_groups_read(path, column, value)
            assert 0 < 2 * admitted <= total and total >= 60
            found = seen[column, value]
            assert (found.n_files, found.all_files) == (admitted, total)
            assert found.n_rows == sum(r[k] == value for r in rows) == stored.filter(F.col(column) == value).count()


def test_a_hot_combination_is_cut_into_several_files(spark, tmp_path):
    rows, path = loans(4000, hot=0.5), str(tmp_path / "t")
    layout.write_clustered(spark.createDataFrame(rows, SCHEMA), path, COLUMNS, "loan_id", 32)
    sizes = [pq.ParquetFile(name).metadata.num_rows for name in glob.glob(f"{path}/*.parquet")]
    assert sum(sizes) == len(rows) and len(sizes) >= 30 and max(sizes) <= 3 * len(rows) / 32
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == rows


def test_nulls_odd_texts_and_empty_tables(spark, tmp_path):
    rows = [(1, None, "p", "w", 1), (None, "A", None, "", 2), (3, None, None, None, 3), (3, "ß", "é", "中", None)] * 3
    df = spark.createDataFrame(rows, SCHEMA)
    layout.write_clustered(df, str(tmp_path / "t"), COLUMNS, "loan_id", 4)
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "t")).collect()), key=repr) == sorted(rows, key=repr)
    layout.write_clustered(df.limit(0), str(tmp_path / "e"), COLUMNS, "loan_id", 4)
    empty = spark.read.schema(df.schema).parquet(str(tmp_path / "e"))
    assert empty.count() == 0 and layout.files_admitted(empty, COLUMNS).count() == 0


def test_places_halve_the_rows_and_bits_alternate(spark):
    df = spark.createDataFrame([(v,) for v in "aaaabbcd"], "c string")
    places = {r.value: r.place for r in layout.value_places(df, ["c"], bits=3).collect()}
    assert places == {"a": 2, "b": 5, "c": 6, "d": 7}
    grid = spark.range(16).select(F.floor(F.col("id") / 4).alias("x"), (F.col("id") % 4).alias("y"))
    cells = grid.withColumn("z", layout.interleaved([F.col("x"), F.col("y")], bits=2)).orderBy("z").collect()
    assert [c.z for c in cells] == list(range(16))
    for a, b in zip(cells, cells[1:]):
        assert ((a.x ^ b.x) | (a.y ^ b.y) << 2).bit_count() == 1
    assert {c.x >> 1 for c in cells[:8]} == {0}  # the first column's highest bit comes first
    with pytest.raises(ValueError, match="fit a long"):
        layout.interleaved([F.lit(0)] * 8)
