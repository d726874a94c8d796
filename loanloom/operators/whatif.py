"""Scoring of tables of hypothetical loans against the existing book, and the same view of stored loans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanloom.functions.columns import safe_ratio
from loanloom.functions.ordered import money_bucket, null_safe_join, positions
from loanloom.functions.shared import materialise
from loanloom.operators.decision import LGD, assign_tier, class_decision
from loanloom.operators.explain import driver_breakdown, increasing_drivers, named_values, shap_values
from loanloom.operators.features import loan_to_income
from loanloom.operators.model import RiskModel, score
from loanloom.operators.portfolio import global_default_rate, rate_ranges_by_grade
from loanloom.operators.quality import flag_ood


def benchmark_hypotheticals(hyp: DataFrame, loans: DataFrame) -> DataFrame:
    """Add the share of the grade's loans at or below the rate, its default rate and the amount's rank.

    The share counts equal rates, unlike the training feature, which is a
    percent rank. Hypothetical and existing values are merged as counts per
    value, so the join works for any number of hypotheticals.
    """
    rates = loans.groupBy("grade", "interest_rate").agg(
        F.count("*").alias("n"),
        F.count("default_flag").alias("known"),
        F.coalesce(F.sum("default_flag"), F.lit(0)).alias("defaults"),
    )
    amounts = loans.groupBy("grade", "loan_amount").agg(F.count("*").alias("n"))
    by_rate = positions(
        hyp.select("grade", "interest_rate").distinct(),
        rates,
        ["grade"],
        "interest_rate",
        measures=["n", "known", "defaults"],
    )
    by_amount = positions(
        hyp.select("grade", "loan_amount").distinct(),
        amounts,
        ["grade"],
        "loan_amount",
        money_bucket(F.col("loan_amount")),
    )
    not_above = F.col("n_below") + F.col("n_equal")
    by_rate = materialise(
        by_rate.select(
            "grade",
            "interest_rate",
            safe_ratio(F.col("defaults_total"), F.col("known_total")).alias("grade_default_rate"),
            safe_ratio(not_above, F.col("n_total")).alias("interest_rate_percentile_in_grade"),
        )
    )
    by_amount = materialise(
        by_amount.select(
            "grade",
            "loan_amount",
            F.when(F.col("n_total") > 0, F.col("n_total") - not_above + 1).alias("loan_amount_rank_in_grade"),
        )
    )
    out = null_safe_join(hyp, by_rate, ["grade", "interest_rate"], "left")
    out = null_safe_join(out, by_amount, ["grade", "loan_amount"], "left")
    return out.select(
        *hyp.columns, "interest_rate_percentile_in_grade", "grade_default_rate", "loan_amount_rank_in_grade"
    )


def hypothetical_features(hyp: DataFrame, loans: DataFrame) -> DataFrame:
    """The model's inputs for hypothetical loans.

    The portfolio's default rate stands in for the region's, and no earlier
    delinquency is assumed, because a hypothetical loan has neither.
    """
    flagged = flag_ood(benchmark_hypotheticals(hyp, loans), rate_ranges_by_grade(loans))
    ratio = loan_to_income(F.col("loan_amount"), F.col("annual_income"))
    return flagged.select(
        "*",
        F.coalesce(ratio, F.lit(0.0)).alias("loan_to_income_ratio"),
        F.lit(0).alias("had_delinquency"),
        global_default_rate(loans).scalar().alias("region_default_rate"),
    )


def _explained(scored: DataFrame, model: RiskModel, lgd: float) -> dict[str, Column]:
    """What is told of a scored loan: PD, one-digit score, action, expected loss, reasons and drivers."""
    pd = F.col("probability_of_default")
    pairs = named_values(F.col("shap"), model.names)
    return {
        "probability_of_default": pd,
        "risk_score": F.bround(pd * 100, 1),
        "recommended_action": F.col("recommended_action"),
        "expected_loss": pd * F.lit(lgd) * F.col("loan_amount").cast("double"),
        "reasons": increasing_drivers(pairs),
        "drivers": driver_breakdown(pairs),
    }


def explain_loans(rows: DataFrame, model: RiskModel, wanted: DataFrame | None = None, lgd: float = LGD) -> DataFrame:
    """Stored loans as a reviewer sees them: score, fixed-cut action, reasons and drivers next to the actual outcome.

    ``rows`` is the model table; ``wanted`` (``loan_id``) narrows it to some loans before anything is scored. The
    outcome is told beside the decision at 0.5, and whether they agree; an unknown outcome agrees with nothing.
    """
    if wanted is not None:
        rows = rows.join(wanted.select("loan_id").distinct(), "loan_id", "left_semi")
    scored = shap_values(model, assign_tier(score(model, rows), mode="fixed"))
    decided = class_decision(F.col("probability_of_default"))
    return scored.select(
        "loan_id",
        "loan_amount",
        "grade",
        "purpose",
        *[c.alias(name) for name, c in _explained(scored, model, lgd).items()],
        decided.alias("predicted_default"),
        F.col("default_flag").alias("actual_default"),
        (decided == F.col("default_flag")).alias("agrees"),
    )


def score_hypotheticals(hyp: DataFrame, loans: DataFrame, model: RiskModel, lgd: float = LGD) -> DataFrame:
    """PD, one-digit score, fixed-cut action, expected loss, drivers and the out-of-distribution flag."""
    scored = shap_values(model, assign_tier(score(model, hypothetical_features(hyp, loans)), mode="fixed"))
    return scored.select(
        *hyp.columns,
        "out_of_distribution",
        "min_rate",
        "max_rate",
        *[c.alias(name) for name, c in _explained(scored, model, lgd).items()],
    )
