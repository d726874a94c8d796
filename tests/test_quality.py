from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from loanloom.operators.quality import audit_keys, clean, flag_ood, group_rare, null_report, winsorize


def _table(spark):
    rows = [
        # loan_id, amount, income, dti, employment, ratio, purpose
        (1, 1000.0, 50000.0, 10.0, None, 0.02, "car"),
        (2, 2000.0, 0.0, 10.0, 3, None, "car"),
        (3, 2000.0, None, 10.0, 3, None, "car"),
        (4, 2000.0, 40000.0, 999.0, 3, 0.05, "car"),
        (5, 2000.0, 40000.0, None, 3, 0.05, "car"),
        (6, 3000.0, 9000000.0, 20.0, 3, 0.0003, "boat"),
        (7, 3000.0, 30000.0, 20.0, 3, 0.1, None),
        (8, 3000.0, 30000.0, 20.0, 3, 0.1, "car"),
    ]
    return spark.createDataFrame(
        rows,
        "loan_id long, loan_amount double, annual_income double, dti double, employment_length int, "
        "loan_to_income_ratio double, purpose string",
    )


def test_cleaning_counts_match_step_by_step(spark):
    df = _table(spark)
    cleaned, report = clean(df, income_quantile=0.5, min_purpose=2)
    row = report.first()
    assert row.n_input == 8
    assert row.n_dropped_income == 3  # zero, missing, and a missing dti
    assert row.n_dropped_dti == 1
    assert row.income_cap == 40000.0  # median of 30000, 30000, 50000, 9000000
    assert row.n_capped == 2
    assert row.n_regrouped == 1
    rows = {r.loan_id: r for r in cleaned.collect()}
    assert set(rows) == {1, 6, 7, 8}
    assert rows[1].employment_length == 0
    assert rows[6].annual_income == 40000.0 and rows[6].loan_to_income_ratio == 0.075
    assert rows[6].purpose == "other" and rows[7].purpose is None and rows[8].purpose == "car"


def test_null_report_lists_only_columns_with_nulls(spark):
    got = {r.column: r.n_null for r in null_report(_table(spark)).collect()}
    assert got == {"annual_income": 1, "dti": 1, "employment_length": 1, "loan_to_income_ratio": 2, "purpose": 1}


@pytest.mark.parametrize("exact", [True, False])
def test_winsorize_keeps_null_and_row_count(spark, exact):
    df = spark.createDataFrame([(float(i),) for i in range(101)] + [(None,)], "v double")
    out = [r.v for r in winsorize(df, "v", 0.9, exact).collect()]
    assert len(out) == 102 and out.count(None) == 1
    assert max(v for v in out if v is not None) == 90.0


def test_grouping_rare_values_under_skew(spark):
    df = spark.range(3000).select(F.expr("case when id % 3 = 0 then 'hot' else concat('p', id % 1000) end").alias("p"))
    got = {r.p: r.n for r in group_rare(df, "p", 10).groupBy("p").agg(F.count("*").alias("n")).collect()}
    assert got["hot"] == 1000 and sum(got.values()) == 3000 and set(got) == {"hot", "other"}


def test_audit_finds_each_kind_of_violation(spark):
    child = spark.createDataFrame([(1, 10), (2, 11), (3, None), (3, 11)], "loan_id long, customer_id long")
    parent = spark.createDataFrame([(10,), (10,), (None,)], "customer_id long")
    got = {(r.check, r.key, r.n_rows) for r in audit_keys(child, parent, "customer_id", "loan_id").collect()}
    assert got == {
        ("missing parent", "11", 2), ("null reference", None, 1), ("null key", None, 1),
        ("duplicate key", "10", 2), ("duplicate child", "3", 2),
    }


def test_rates_outside_the_grade_are_flagged(spark):
    ranges = spark.createDataFrame([("A", 5.0, 8.0)], "grade string, min_rate double, max_rate double")
    loans = spark.createDataFrame([("A", 5.0), ("A", 8.1), ("Q", 6.0)], "grade string, interest_rate double")
    assert sorted((r.grade, r.out_of_distribution) for r in flag_ood(loans, ranges).collect()) == [
        ("A", 0), ("A", 1), ("Q", 1),
    ]


def _counting(spark, df):
    """``df`` whose evaluated rows are counted."""
    passes = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def seen(x):
        passes.add(1)
        return x

    return df.withColumn("loan_id", seen("loan_id")), passes


def test_cleaning_evaluates_its_input_once(spark):
    rows = [(i, 1000.0 + i, 500.0 * (i % 7), float(i % 130), 0.1, None if i % 5 else 3, "car" if i % 3 else "boat", i % 2) for i in range(300)]
    df = spark.createDataFrame(rows, "loan_id long, loan_amount double, annual_income double, dti double, loan_to_income_ratio double, employment_length int, purpose string, default_flag int")
    counted, passes = _counting(spark, df)
    cleaned, report = clean(counted, min_purpose=50)
    kept, told = cleaned.select("loan_id").collect(), report.first()
    assert passes.value == 300
    usable = [r for r in rows if r[2] > 0]
    assert told.n_input == 300 and told.n_dropped_income == 300 - len(usable)
    assert told.n_dropped_dti == sum(r[3] >= 100 for r in usable) and len(kept) == len(usable) - told.n_dropped_dti

