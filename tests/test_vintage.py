from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from loanloom.operators.vintage import crisis_comparison, origination_drift, vintage_analysis, vintage_loan_base


def _literal(base, buckets):
    """Every loan against every bucket, as the textbook query does; for small tables only."""
    totals = base.groupBy("origination_quarter").agg(F.count("*").alias("cohort_size"))
    grid = totals.crossJoin(buckets)
    hit = (F.col("default_flag") == 1) & (F.col("months_on_book") <= F.col("mob_bucket"))
    return (
        grid.join(base, "origination_quarter")
        .groupBy("origination_quarter", "cohort_size", "mob_bucket")
        .agg(F.count_if(hit).alias("cumulative_defaults"))
    )


def _base(spark, n=2000):
    return spark.range(n).select(
        F.col("id").alias("loan_id"),
        F.expr("case when id % 3 = 0 then '2008-Q1' when id = 1 then '2012-Q4' else concat('20', 10 + id % 7, '-Q2') end")
        .alias("origination_quarter"),
        F.expr("cast((id * 31) % 5 div 4 as int)").alias("default_flag"),
        F.expr("cast((id * 17) % 61 as int)").alias("months_on_book"),
    )


def test_prefix_sums_equal_the_literal_grid(spark):
    base = _base(spark)
    buckets = spark.range(0, 61, 3).select(F.col("id").cast("int").alias("mob_bucket"))
    columns = ["origination_quarter", "cohort_size", "mob_bucket", "cumulative_defaults"]
    got = {tuple(r) for r in vintage_analysis(base).select(*columns).collect()}
    assert got == {tuple(r) for r in _literal(base, buckets).select(*columns).collect()}


def test_curves_rise_to_the_cohort_default_share(spark):
    base = _base(spark)
    shares = {
        r.origination_quarter: r.share
        for r in base.groupBy("origination_quarter").agg(F.avg("default_flag").alias("share")).collect()
    }
    curves = {}
    for r in vintage_analysis(base).collect():
        curves.setdefault(r.origination_quarter, []).append((r.mob_bucket, r.cumulative_default_rate, r.is_crisis_vintage))
    for quarter, points in curves.items():
        assert len(points) == 21
        rates = [p[1] for p in sorted(points)]
        assert rates == sorted(rates)
        assert abs(rates[-1] - shares[quarter]) <= 5e-5
        assert {p[2] for p in points} == {int(quarter.startswith("2008"))}


def test_gaps_of_less_than_a_month_count_as_zero_both_ways(spark):
    d = datetime.date
    loans = spark.createDataFrame(
        [(i, d(2015, 5, 20), 1) for i in range(5)] + [(9, None, 1)], "loan_id long, issue_date date, default_flag int"
    )
    paid = [(0, d(2015, 5, 10)), (1, d(2015, 6, 19)), (2, d(2015, 4, 1)), (3, d(2020, 5, 20)), (4, None), (9, d(2020, 1, 1))]
    repayments = spark.createDataFrame(paid, "loan_id long, payment_date date")
    got = {r.loan_id: r.months_on_book for r in vintage_loan_base(loans, repayments).collect()}
    assert got == {0: 0, 1: 0, 3: 60}
    labels = {r.origination_quarter for r in vintage_loan_base(loans, repayments).collect()}
    assert labels == {"2015-Q2"}


def test_no_crisis_cohorts_gives_zeros(spark):
    row = crisis_comparison(vintage_analysis(_base(spark), crisis_years=())).first()
    assert (row.crisis_loans, row.crisis_rate, row.crisis_quarters) == (0, 0.0, 0)
    assert row.relative_difference == -1.0 and row.finding == "no crisis effect"


def test_drift_without_a_baseline_year(spark):
    yearly = spark.createDataFrame(
        [(2011, 10, 0.2), (2012, 10, 0.3), (2013, 10, 0.3)], "origination_year int, n_loans long, default_rate double"
    )
    row = origination_drift(yearly).first()
    assert row.baseline_rate is None and row.peak_year == 2012 and row.censored_from_year == 2011
