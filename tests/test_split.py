from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from loanloom.operators.split import hash_split, sample_n, stratified_split


def _loans(spark, n=20000):
    return spark.range(n).select(F.col("id").alias("loan_id"), F.expr("cast((id * 31) % 5 div 4 as int)").alias("y"))


@pytest.mark.parametrize("method", ["wide", "modular"])
@pytest.mark.parametrize("n", [1, 777, 20000, 50000])
def test_sample_has_exactly_n_rows_and_ignores_partitioning(spark, method, n):
    df = _loans(spark)
    picked = {r.loan_id for r in sample_n(df, n, "loan_id", method=method).collect()}
    again = {r.loan_id for r in sample_n(df.repartition(13), n, "loan_id", method=method).collect()}
    assert len(picked) == min(n, 20000)
    assert picked == again


def test_samples_of_other_seeds_differ(spark):
    df = _loans(spark)
    a, b = ({r.loan_id for r in sample_n(df, 500, "loan_id", seed=s).collect()} for s in (1, 2))
    assert a != b


@pytest.mark.parametrize("exact", [False, True])
def test_split_is_a_partition_with_the_right_shares(spark, exact):
    # Large enough for a one-point band to lie beyond the noise of a hash split.
    n = 200_000
    df = _loans(spark, n)
    def split(rows):
        return stratified_split(rows, "y", "loan_id") if exact else hash_split(rows, "loan_id")

    rows, again = split(df), split(df.repartition(7))
    first = {r.loan_id: r.split for r in rows.collect()}
    assert len(first) == n and first == {r.loan_id: r.split for r in again.collect()}
    for r in rows.groupBy("y", "split").agg(F.count("*").alias("n")).collect():
        stratum = n // 5 if r.y else n * 4 // 5
        share = {"train": 0.6, "calibration": 0.2, "test": 0.2}[r.split]
        assert abs(r.n - share * stratum) <= (0.5 if exact else 0.01 * stratum)


def test_small_and_unknown_strata_are_split_too(spark):
    rows = [(i, None if i < 7 else 1 if i == 7 else 0) for i in range(40)]
    df = spark.createDataFrame(rows, "loan_id long, y int")
    counts = {(r.y, r.split): r.n for r in stratified_split(df, "y", "loan_id").groupBy("y", "split").agg(F.count("*").alias("n")).collect()}
    assert counts == {
        (None, "train"): 4, (None, "calibration"): 2, (None, "test"): 1, (1, "train"): 1,
        (0, "train"): 19, (0, "calibration"): 7, (0, "test"): 6,
    }
    assert stratified_split(df.limit(0), "y", "loan_id").count() == 0
