"""Unemployment sensitivity of default rates and expected loss under stress scenarios."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanloom.functions.columns import clip, safe_ratio
from loanloom.functions.shared import materialise
from loanloom.functions.student_t import t_quantile
from loanloom.operators.decision import LGD
from loanloom.schemas import STRESS_TEST_RESULTS, enforce_schema
from loanloom.sources.tables import SCENARIOS, Scenario


def annual_mean(macro: DataFrame) -> DataFrame:
    return macro.groupBy(F.year("observation_date").alias("year")).agg(F.avg("value").alias("unemployment_rate"))


def yearly_with_macro(yearly: DataFrame, macro: DataFrame) -> DataFrame:
    """Origination quality of the years the macro series covers, rates in percentage points."""
    return yearly.join(annual_mean(macro), F.col("origination_year") == F.col("year")).select(
        "origination_year",
        "n_loans",
        "default_rate",
        "unemployment_rate",
        (F.col("default_rate") * 100).alias("default_rate_pp"),
    )


def two_regressor_fit(df: DataFrame, y: str, x: str, z: str, alpha: float = 0.05) -> DataFrame:
    """Least squares y ~ 1 + x + z from sums of squares: slopes, R squared and the interval of x's slope.

    One aggregate over ``df``, of which the row count comes to the driver for the t quantile. Slopes are NULL when x and z are collinear, the
    interval is NULL without residual degrees of freedom.
    """
    n = F.count("*").cast("double")

    def cross(a: str, b: str) -> Column:
        return F.covar_pop(F.col(a).cast("double"), F.col(b).cast("double")) * n

    known = df.filter(F.col(y).isNotNull() & F.col(x).isNotNull() & F.col(z).isNotNull())
    sums = known.agg(
        F.count("*").alias("n"),
        cross(x, x).alias("xx"), cross(z, z).alias("zz"), cross(x, z).alias("xz"),
        cross(x, y).alias("xy"), cross(z, y).alias("zy"), cross(y, y).alias("yy"),
        F.min(z).alias("first"), F.max(z).alias("last"),
    )
    sums = materialise(sums)
    dof = sums.first()["n"] - 3
    quantile = F.lit(t_quantile(1 - alpha / 2, dof) if dof > 0 else None)
    c = F.col
    det = c("xx") * c("zz") - c("xz") * c("xz")
    fitted = sums.withColumns(
        {
            "slope": safe_ratio(c("xy") * c("zz") - c("zy") * c("xz"), det),
            "trend_slope": safe_ratio(c("zy") * c("xx") - c("xy") * c("xz"), det),
            "predictor_corr": safe_ratio(c("xz"), F.sqrt(c("xx") * c("zz"))),
            "dof": c("n") - 3,
        }
    ).withColumn("residual", c("yy") - c("slope") * c("xy") - c("trend_slope") * c("zy"))
    spread = F.sqrt(safe_ratio(c("residual"), c("dof")) * safe_ratio(c("zz"), det))
    margin = quantile * spread
    return fitted.select(
        c("n").alias("n_years"),
        c("dof").alias("degrees_of_freedom"),
        "slope",
        "trend_slope",
        (1 - safe_ratio(c("residual"), c("yy"))).alias("r_squared"),
        (c("slope") - margin).alias("ci_lower"),
        (c("slope") + margin).alias("ci_upper"),
        "predictor_corr",
        c("first").alias("first_year"),
        c("last").alias("last_year"),
    )


def fit_sensitivity(yearly: DataFrame, macro: DataFrame, alpha: float = 0.05) -> DataFrame:
    """One row: default-rate sensitivity to unemployment net of the origination-year trend.

    ``applied`` is the interval's upper end, floored at zero: the most cautious
    sensitivity the data still allows.
    """
    fit = two_regressor_fit(
        yearly_with_macro(yearly, macro), "default_rate_pp", "unemployment_rate", "origination_year", alpha
    )
    return fit.withColumn("applied", F.when(F.col("ci_upper").isNotNull(), F.greatest(F.col("ci_upper"), F.lit(0.0))))


def weighted_default_rate(yearly: DataFrame) -> DataFrame:
    return yearly.agg(
        safe_ratio(F.sum(F.col("n_loans") * F.col("default_rate")), F.sum("n_loans")).alias("rate")
    )


def year_risk(yearly: DataFrame) -> DataFrame:
    """Each origination year's default rate relative to the portfolio's."""
    portfolio = weighted_default_rate(yearly).scalar()
    return yearly.select(
        "origination_year", safe_ratio(F.col("default_rate"), portfolio).alias("year_risk_scalar")
    )


def exposure_by_year_and_pd(scores: DataFrame, loans: DataFrame, yearly: DataFrame) -> DataFrame:
    """Exposure summed per origination year and stored PD, with the year's risk scalar.

    Loans of one year and PD shift alike, so scenarios only meet these sums: at
    most 100,001 five-digit PDs per year, however many loans there are.
    """
    dated = loans.filter(F.col("issue_date").isNotNull()).select(
        "loan_id", F.year("issue_date").alias("origination_year")
    )
    sums = (
        scores.select("loan_id", "probability_of_default", "exposure_at_default")
        .join(dated, "loan_id")
        .groupBy("origination_year", F.round("probability_of_default", 5).cast("double").alias("pd"))
        .agg(F.sum(F.col("exposure_at_default").cast("decimal(12,2)")).alias("exposure"), F.count("*").alias("n"))
    )
    return sums.join(year_risk(yearly), "origination_year")


def stress_el(
    scores: DataFrame,
    loans: DataFrame,
    yearly: DataFrame,
    sensitivity: DataFrame,
    scenarios: Sequence[Scenario] = tuple(SCENARIOS),
    lgd: float = LGD,
) -> DataFrame:
    """Expected loss per scenario, every PD moved by its scenario and year and kept within 0..1.

    All scenarios are evaluated in the same pass over the grouped exposures.
    """
    applied = sensitivity.select(F.col("applied")).scalar()
    cases = F.array(
        *[
            F.struct(
                F.lit(s.scenario).alias("scenario"),
                F.lit(float(s.delta_pp)).alias("delta_pp"),
                F.lit(s.source).alias("source"),
            )
            for s in scenarios
        ]
    )
    grouped = exposure_by_year_and_pd(scores, loans, yearly)
    shift = (applied * F.col("delta_pp") / 100) * F.col("year_risk_scalar")
    shifted = clip(F.col("pd") + shift, lower=0.0, upper=1.0)
    return (
        grouped.select("pd", "exposure", "n", "year_risk_scalar", F.inline(cases))
        .groupBy("scenario", "delta_pp", "source")
        .agg(
            F.round(F.sum(shifted * F.lit(lgd) * F.col("exposure").cast("double")), 2).alias("portfolio_el"),
            F.sum("n").alias("n_loans"),
        )
    )


def stress_rows(
    results: DataFrame, sensitivity: DataFrame, run_date: datetime.date | None = None
) -> DataFrame:
    """Rows of stress_test_results from scenario losses and the fitted sensitivity."""
    fit = sensitivity.select(F.struct("*").alias("fit")).scalar()
    stamp = F.current_date() if run_date is None else F.lit(run_date)
    rows = results.select(
        "scenario",
        F.col("delta_pp").alias("unemployment_delta_pp"),
        F.col("source").alias("scenario_source"),
        "portfolio_el",
        fit.getField("slope").alias("pd_sensitivity_slope"),
        fit.getField("r_squared").alias("sensitivity_r_squared"),
        fit.getField("ci_lower").alias("sensitivity_ci_lower"),
        fit.getField("ci_upper").alias("sensitivity_ci_upper"),
        fit.getField("applied").alias("applied_sensitivity_pp"),
        fit.getField("n_years").alias("n_years_fitted"),
        stamp.alias("run_date"),
    )
    return enforce_schema(rows, STRESS_TEST_RESULTS)


def increase_vs_baseline(results: DataFrame, baseline: str = "baseline") -> DataFrame:
    """Loss increase of every other scenario over the baseline; empty without a baseline row."""
    kept = materialise(results)
    base = kept.filter(F.col("scenario") == baseline).agg(F.max("portfolio_el").alias("el")).scalar()
    return (
        kept.filter(F.col("scenario") != baseline)
        .select("scenario", F.col("portfolio_el").cast("double").alias("portfolio_el"), base.cast("double").alias("b"))
        .filter("b is not null")
        .select("scenario", "portfolio_el", F.round(F.col("portfolio_el") - F.col("b"), 2).alias("increase"))
    )
