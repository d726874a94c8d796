"""Origination cohorts and their cumulative default curves."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanloom.functions.columns import quarter_label, ratio_or_zero, safe_ratio, whole_months

# Origination years of the crisis window.
CRISIS_YEARS = (2007, 2008, 2009)


def vintage_loan_base(loans: DataFrame, repayments: DataFrame, max_months: int = 60) -> DataFrame:
    """Loans with a payment 0..max_months after issue. A gap below one month counts as 0 either way."""
    paid = repayments.filter(F.col("payment_date").isNotNull()).select("loan_id", "payment_date")
    issued = loans.filter(F.col("issue_date").isNotNull()).select("loan_id", "issue_date", "default_flag")
    return (
        issued.join(paid, "loan_id")
        .select(
            "loan_id",
            quarter_label(F.col("issue_date")).alias("origination_quarter"),
            "default_flag",
            whole_months(F.col("issue_date"), F.col("payment_date")).alias("months_on_book"),
        )
        .filter(F.col("months_on_book").between(0, max_months))
    )


def vintage_analysis(
    base: DataFrame, step: int = 3, max_months: int = 60, crisis_years: Sequence[int] = CRISIS_YEARS
) -> DataFrame:
    """Cumulative defaults per origination quarter and months-on-book bucket.

    Loans are first counted per quarter and bucket; the 0, step, .. grid is laid
    over those counts and summed up along it. The loans themselves are never
    multiplied by the buckets.
    """
    bucket = (F.ceil(F.col("months_on_book") / step) * step).cast("int")
    counted = base.groupBy("origination_quarter", bucket.alias("mob_bucket")).agg(
        F.count("*").alias("loans"),
        F.count_if(F.col("default_flag") == 1).alias("defaults"),
    )
    # One row per quarter with its counts as a map: the grid needs no second pass and no join.
    cohorts = counted.groupBy("origination_quarter").agg(
        F.sum("loans").alias("cohort_size"),
        F.map_from_entries(F.collect_list(F.struct("mob_bucket", "defaults"))).alias("by_bucket"),
    )
    grid = cohorts.select(
        "origination_quarter",
        "cohort_size",
        "by_bucket",
        F.explode(F.sequence(F.lit(0), F.lit(max_months), F.lit(step))).alias("mob_bucket"),
    )
    so_far = Window.partitionBy("origination_quarter").orderBy("mob_bucket")
    here = F.coalesce(F.try_element_at("by_bucket", F.col("mob_bucket")), F.lit(0))
    curve = grid.withColumn(
        "cumulative_defaults", F.sum(here).over(so_far.rowsBetween(Window.unboundedPreceding, 0))
    )
    crisis = F.left("origination_quarter", F.lit(4)).isin(*[str(y) for y in crisis_years])
    return curve.select(
        "origination_quarter",
        "cohort_size",
        "mob_bucket",
        "cumulative_defaults",
        F.round(safe_ratio(F.col("cumulative_defaults"), F.col("cohort_size")), 4).alias("cumulative_default_rate"),
        F.when(crisis, 1).otherwise(0).alias("is_crisis_vintage"),
    ).orderBy("origination_quarter", "mob_bucket")


def crisis_comparison(vintage: DataFrame, month: int = 36, min_effect: float = 0.15) -> DataFrame:
    """Crisis cohorts against all others at one age, and whether the gap counts as an effect."""
    crisis = F.col("is_crisis_vintage") == 1
    at_month = F.col("mob_bucket") == month

    def total(column: str, side: Column) -> Column:
        return F.coalesce(F.sum(F.when(side & at_month, F.col(column))), F.lit(0))

    row = vintage.agg(
        total("cohort_size", crisis).alias("crisis_loans"),
        total("cohort_size", ~crisis).alias("other_loans"),
        total("cumulative_defaults", crisis).alias("crisis_defaults"),
        total("cumulative_defaults", ~crisis).alias("other_defaults"),
        F.count_distinct(F.when(crisis, F.col("origination_quarter"))).alias("crisis_quarters"),
    )
    rated = row.select(
        "crisis_loans",
        "other_loans",
        "crisis_quarters",
        ratio_or_zero(F.col("crisis_defaults"), F.col("crisis_loans")).alias("crisis_rate"),
        ratio_or_zero(F.col("other_defaults"), F.col("other_loans")).alias("other_rate"),
    )
    relative = ratio_or_zero(F.col("crisis_rate") - F.col("other_rate"), F.col("other_rate"))
    return rated.withColumn("relative_difference", relative).withColumn(
        "finding",
        F.when(F.col("relative_difference") > min_effect, "crisis effect").otherwise("no crisis effect"),
    )


def origination_drift(yearly: DataFrame, baseline_year: int = 2010) -> DataFrame:
    """Baseline rate, peak year and rate, last year, and the last three, still-maturing years."""
    rate_then_earliest = F.struct(F.col("default_rate"), -F.col("origination_year"))
    return yearly.agg(
        F.max(F.when(F.col("origination_year") == baseline_year, F.col("default_rate"))).alias("baseline_rate"),
        F.max_by("origination_year", rate_then_earliest).alias("peak_year"),
        F.max("default_rate").alias("peak_rate"),
        F.max("origination_year").alias("last_year"),
    ).select(
        F.lit(baseline_year).alias("baseline_year"),
        "baseline_rate",
        "peak_year",
        "peak_rate",
        "last_year",
        (F.col("last_year") - 2).alias("censored_from_year"),
    )
