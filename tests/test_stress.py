from __future__ import annotations

import datetime

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from loanloom.functions.student_t import t_quantile
from loanloom.operators.stress import fit_sensitivity, increase_vs_baseline, stress_el, stress_rows, two_regressor_fit
from loanloom.sources.tables import SCENARIOS, Scenario


def _series(spark):
    rows = [(2007 + i, 100 + i, round(0.1 + 0.013 * i + 0.004 * ((i * 7) % 5), 4), 5.0 + (i * 3) % 4) for i in range(12)]
    return spark.createDataFrame(rows, "origination_year int, n_loans long, default_rate double, u double")


def _macro(series):
    return series.select(F.make_date("origination_year", F.lit(6), F.lit(1)).alias("observation_date"), F.col("u").alias("value"))


def test_closed_form_equals_linear_regression(spark):
    series = _series(spark).withColumn("y", F.col("default_rate") * 100).withColumn("z", F.col("origination_year").cast("double"))
    fit = two_regressor_fit(series, "y", "u", "z").first()
    rows = VectorAssembler(inputCols=["u", "z"], outputCol="x").transform(series)
    model = LinearRegression(featuresCol="x", labelCol="y", solver="normal").fit(rows)
    assert fit.slope == pytest.approx(model.coefficients[0], rel=1e-8)
    assert fit.trend_slope == pytest.approx(model.coefficients[1], rel=1e-8)
    assert fit.r_squared == pytest.approx(model.summary.r2, rel=1e-8)
    error = model.summary.coefficientStandardErrors[0]
    assert fit.ci_upper - fit.slope == pytest.approx(t_quantile(0.975, 9) * error, rel=1e-7)
    assert (fit.n_years, fit.degrees_of_freedom) == (12, 9)


def test_collinear_predictors_have_no_slope(spark):
    flat = spark.range(5).select(F.col("id").alias("y"), F.lit(4.0).alias("u"), F.col("id").alias("z"))
    row = two_regressor_fit(flat, "y", "u", "z").first()
    assert row.slope is None and row.ci_upper is None and row.predictor_corr is None


def _book(spark):
    loans = spark.range(1200).select(
        F.col("id").alias("loan_id"), F.make_date((2007 + F.col("id") % 12).cast("int"), F.lit(3), F.lit(1)).alias("issue_date")
    )
    scores = spark.range(1200).select(
        F.col("id").alias("loan_id"),
        F.expr("cast((id * 37) % 100 / 100 as decimal(6,5))").alias("probability_of_default"),
        F.expr("cast(1000 + id as decimal(12,2))").alias("exposure_at_default"),
    )
    return loans, scores


def test_losses_grow_with_the_shock_and_match_loan_by_loan(spark):
    loans, scores = _book(spark)
    series = _series(spark)
    fit = fit_sensitivity(series, _macro(series))
    none = Scenario("none", 0.0, "no move")
    got = {r.scenario: r.portfolio_el for r in stress_el(scores, loans, series, fit, [none, *SCENARIOS]).collect()}
    assert got["none"] <= got["baseline"] <= got["adverse"] <= got["severely_adverse"]

    applied = fit.first().applied
    years = {r.origination_year: (r.n_loans, r.default_rate) for r in series.collect()}
    average = sum(n * r for n, r in years.values()) / sum(n for n, _ in years.values())
    issued = {r.loan_id: r.issue_date.year for r in loans.collect()}
    for scenario in [none, *SCENARIOS]:
        total = 0.0
        for s in scores.collect():
            scalar = years[issued[s.loan_id]][1] / average
            pd = min(max(float(s.probability_of_default) + applied * scenario.delta_pp / 100 * scalar, 0.0), 1.0)
            total += pd * 0.45 * float(s.exposure_at_default)
        assert got[scenario.scenario] == pytest.approx(total, abs=0.02)


def test_rows_and_increase(spark):
    loans, scores = _book(spark)
    series = _series(spark)
    fit = fit_sensitivity(series, _macro(series))
    results = stress_el(scores, loans, series, fit)
    rows = stress_rows(results, fit, datetime.date(2024, 1, 1)).collect()
    assert len(rows) == 3 and {r.n_years_fitted for r in rows} == {12} and len(rows[0]) == 11
    grown = {r.scenario: r.increase for r in increase_vs_baseline(results).collect()}
    assert set(grown) == {"adverse", "severely_adverse"} and grown["severely_adverse"] >= grown["adverse"] >= 0
    assert increase_vs_baseline(results.filter("scenario <> 'baseline'")).count() == 0
