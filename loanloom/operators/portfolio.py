"""Aggregates behind the portfolio reports."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanloom.functions.columns import month_start_label, safe_ratio
from loanloom.operators.decision import TIER_ORDER, TOP_TIER


def monthly_default_trend(loans: DataFrame, window: int = 3, rate_digits: int | None = None) -> DataFrame:
    """Loans and defaults per issue month with a mean over the last ``window`` months that have loans.

    The window has no partition: its input is one row per calendar month.
    """
    rate = F.avg("default_flag")
    monthly = (
        loans.filter(F.col("issue_date").isNotNull())
        .groupBy(month_start_label(F.col("issue_date")).alias("issue_month"))
        .agg(
            F.count("*").alias("loans_issued"),
            F.sum("default_flag").alias("loans_defaulted"),
            (rate if rate_digits is None else F.round(rate, rate_digits)).alias("monthly_default_rate"),
        )
    )
    recent = Window.partitionBy(F.lit(0)).orderBy("issue_month").rowsBetween(1 - window, 0)
    return monthly.withColumn(
        f"rolling_{window}m_default_rate", F.avg("monthly_default_rate").over(recent)
    ).orderBy("issue_month")


def default_rate_by(
    loans: DataFrame, key: str, min_count: int | None = None, limit: int | None = None, digits: int | None = 4
) -> DataFrame:
    """Loans and default rate per ``key`` with more than ``min_count`` loans, riskiest first."""
    rate = F.avg("default_flag")
    rated = loans.groupBy(key).agg(
        F.count("*").alias("n_loans"), (rate if digits is None else F.round(rate, digits)).alias("default_rate")
    )
    if min_count is not None:
        rated = rated.filter(F.col("n_loans") > min_count)
    ordered = rated.orderBy(F.col("default_rate").desc_nulls_last(), F.col(key).asc_nulls_first())
    return ordered if limit is None else ordered.limit(limit)


def default_rate_by_region(
    loans: DataFrame, customers: DataFrame, min_count: int | None = 200, limit: int | None = 5
) -> DataFrame:
    """Riskiest regions. Loans are counted per customer before the join, so it moves one row per customer."""
    per_customer = loans.groupBy("customer_id").agg(
        F.count("*").alias("n"), F.count("default_flag").alias("known"), F.sum("default_flag").alias("defaults")
    )
    rated = (
        per_customer.join(customers.select("customer_id", "region"), "customer_id")
        .groupBy("region")
        .agg(
            F.sum("n").alias("n_loans"),
            F.round(safe_ratio(F.sum("defaults"), F.sum("known")), 4).alias("default_rate"),
        )
    )
    if min_count is not None:
        rated = rated.filter(F.col("n_loans") > min_count)
    ordered = rated.orderBy(F.col("default_rate").desc_nulls_last(), F.col("region").asc_nulls_first())
    return ordered if limit is None else ordered.limit(limit)


def yearly_origination_quality(loans: DataFrame) -> DataFrame:
    return (
        loans.filter(F.col("issue_date").isNotNull())
        .groupBy(F.year("issue_date").alias("origination_year"))
        .agg(F.count("*").alias("n_loans"), F.round(F.avg("default_flag"), 4).alias("default_rate"))
        .orderBy("origination_year")
    )


def global_default_rate(loans: DataFrame) -> DataFrame:
    return loans.agg(F.avg("default_flag").alias("rate"))


def rate_ranges_by_grade(loans: DataFrame) -> DataFrame:
    return loans.groupBy("grade").agg(
        F.min("interest_rate").alias("min_rate"), F.max("interest_rate").alias("max_rate")
    )


def loans_with_payments(
    loans: DataFrame, repayments: DataFrame, start: datetime.date | str, end: datetime.date | str
) -> DataFrame:
    """Loans issued in ``start``..``end`` with their payments; the date range reaches the file scan.

    Tables stored by origination year, loans and repayments alike, are also pruned to the years of the range.
    """
    first, last = F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date")
    years = F.col("origination_year").between(int(str(start)[:4]), int(str(end)[:4]))
    loans, repayments = (t.filter(years) if "origination_year" in t.columns else t for t in (loans, repayments))
    return (
        loans.filter(F.col("issue_date").between(first, last))
        .select("loan_id", "loan_amount", "issue_date")
        .join(repayments.select("loan_id", "amount_paid", "days_late"), "loan_id")
    )


def point_lookup(df: DataFrame, key: str, value) -> DataFrame:
    return df.filter(F.col(key) == F.lit(value))


def overview_kpis(features: DataFrame, scores: DataFrame) -> DataFrame:
    """One row: loans, defaults, default rate, mean score and loans under manual review."""
    scored = scores.agg(
        F.struct(
            F.avg(F.col("risk_score").cast("double")).alias("mean_score"),
            F.count_if(F.col("recommended_action") == TOP_TIER).alias("manual_review"),
        ).alias("s")
    ).scalar()
    return features.agg(
        F.count("*").alias("total_loans"),
        F.avg("default_flag").alias("default_rate"),
        F.sum("default_flag").alias("n_defaults"),
    ).select(
        "total_loans",
        "default_rate",
        "n_defaults",
        scored.getField("mean_score").alias("avg_risk_score"),
        scored.getField("manual_review").alias("manual_review_loans"),
    )


def scores_with_outcome(scores: DataFrame, features: DataFrame) -> DataFrame:
    return scores.join(features.select("loan_id", "loan_amount", "default_flag"), "loan_id")


def high_risk_exposure(scores: DataFrame, features: DataFrame, tier: str = TOP_TIER) -> DataFrame:
    """Count, amount and default rate of the loans in one tier; the rate is 0 when it is empty."""
    flagged = scores_with_outcome(scores.filter(F.col("recommended_action") == tier), features)
    return flagged.agg(
        F.count("*").alias("n_loans"),
        F.coalesce(F.sum("loan_amount").cast("double"), F.lit(0.0)).alias("exposure_amount"),
        F.coalesce(F.avg("default_flag"), F.lit(0.0)).alias("default_rate"),
    )


def in_tier_order(per_tier: DataFrame, tier_col: str = "recommended_action", fill: dict | None = None) -> DataFrame:
    """One row per tier in the fixed order, also for tiers ``per_tier`` lacks."""
    order = per_tier.sparkSession.createDataFrame(
        [(i, t) for i, t in enumerate(TIER_ORDER, 1)], f"position int, {tier_col} string"
    )
    rows = order.join(per_tier, tier_col, "left")
    return (rows.fillna(fill) if fill else rows).orderBy("position")


def expected_loss_by_tier(scores: DataFrame) -> DataFrame:
    """Expected loss per tier next to the total; exact decimal sums, empty tiers at 0."""
    per_tier = scores.groupBy("recommended_action").agg(F.sum("expected_loss").cast("double").alias("expected_loss"))
    total = F.sum("expected_loss").over(Window.partitionBy(F.lit(0)))
    tiers = in_tier_order(per_tier, fill={"expected_loss": 0.0})
    return tiers.withColumn("total_expected_loss", F.round(total, 2)).orderBy("position")


def default_rate_by_tier(scores: DataFrame, features: DataFrame) -> DataFrame:
    per_tier = (
        scores_with_outcome(scores, features)
        .groupBy("recommended_action")
        .agg(F.avg("default_flag").alias("default_rate"))
    )
    return in_tier_order(per_tier)


def tier_counts(df: DataFrame) -> DataFrame:
    """Loans per tier in the fixed order; a missing tier has a NULL count, unscored loans are left out."""
    return in_tier_order(df.groupBy("recommended_action").agg(F.count("*").alias("n_loans")))


def score_histogram(scores: DataFrame, bins: int = 30, column: str = "risk_score") -> DataFrame:
    """Counts in ``bins`` equal-width bins between the smallest and largest score, the last one closed."""
    # Scores carry two digits, so counting per score first leaves at most 10,001 rows.
    counts = scores.filter(F.col(column).isNotNull()).groupBy(F.col(column).cast("double").alias("v")).count()
    span = counts.agg(F.struct(F.min("v").alias("lo"), F.max("v").alias("hi")).alias("s")).scalar()
    ranged = counts.select("v", "count", span.getField("lo").alias("lo"), span.getField("hi").alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    bin_of = F.least(F.floor(F.coalesce(safe_ratio(F.col("v") - F.col("lo"), width), F.lit(0.0))), F.lit(bins - 1))
    return (
        ranged.groupBy(bin_of.cast("int").alias("bin"), "lo", width.alias("width"))
        .agg(F.sum("count").alias("n_loans"))
        .select(
            "bin",
            (F.col("lo") + F.col("bin") * F.col("width")).alias("bin_start"),
            (F.col("lo") + (F.col("bin") + 1) * F.col("width")).alias("bin_end"),
            "n_loans",
        )
        .orderBy("bin")
    )


#: What the portfolio is filtered by.
FILTER_COLUMNS = ("grade", "purpose", "recommended_action")


def with_tier(features: DataFrame, scores: DataFrame) -> DataFrame:
    """Features with their recommended action; unscored loans stay, with NULL."""
    return features.join(scores.select("loan_id", "recommended_action"), "loan_id", "left")


def filter_portfolio(
    df: DataFrame,
    grade: str | None = None,
    purpose: str | None = None,
    tier: str | None = None,
    defaulted: bool | None = None,
) -> DataFrame:
    """Rows matching every filter that is set."""
    wanted: dict[str, object] = {"grade": grade, "purpose": purpose, "recommended_action": tier}
    if defaulted is not None:
        wanted["default_flag"] = int(defaulted)
    for column, value in wanted.items():
        if value is not None:
            df = df.filter(F.col(column) == F.lit(value))
    return df


def filter_counts(df: DataFrame, **filters) -> DataFrame:
    """Rows shown and rows overall, in one pass over ``df``."""
    condition: Column = F.lit(True)
    for column, value in filters.items():
        condition = condition & (F.col(column) == F.lit(value))
    return df.agg(F.count_if(condition).alias("shown"), F.count("*").alias("total"))


def scores_for(scores: DataFrame, loans: DataFrame) -> DataFrame:
    return scores.join(loans.select("loan_id"), "loan_id", "left_semi")


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(F.col(column).asc_nulls_first())


def latest_model(monitoring: DataFrame) -> DataFrame:
    row = F.struct(*monitoring.columns)
    newest = F.struct("trained_date", "model_version")
    return monitoring.agg(F.max_by(row, newest).alias("m")).filter("m is not null").select("m.*")


def model_history(monitoring: DataFrame) -> DataFrame:
    return monitoring.orderBy(F.col("trained_date").desc_nulls_last(), F.col("model_version").desc())


def preview(df: DataFrame, columns: Sequence[str], order_by: Sequence[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows in a stated order."""
    return df.orderBy(*order_by).limit(n).select(*columns)
