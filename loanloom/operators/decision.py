"""Risk tiers and expected loss."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Recommended actions from mildest to most severe, cut-offs and the loss-given-default assumption.
TIER_ORDER = ["Standard monitoring", "Increase monitoring", "Reduce credit limit", "Manual review"]
TOP_TIER = "Manual review"
TIER_QUANTILES = (0.5, 0.8, 0.95)
FIXED_CUTOFFS = (25.0, 50.0, 75.0)
LGD = 0.45


def risk_score(pd: Column) -> Column:
    """0..100 score with two digits, ties to even."""
    return F.bround(pd * 100, 2)


def tier_cutoffs(scores: DataFrame, qs: Sequence[float] = TIER_QUANTILES, column: str = "risk_score") -> DataFrame:
    """One row with an array of score quantiles.

    Scores have two digits between 0 and 100, so the exact aggregate buffers at
    most 10,001 counts however many loans are scored.
    """
    score = F.round(F.col(column).cast("double"), 2)
    return scores.agg(F.percentile(score, F.array(*[F.lit(float(q)) for q in qs])).alias("cutoffs"))


def _tier(score: Column, low: Column, middle: Column, high: Column) -> Column:
    return (
        F.when(score >= high, TIER_ORDER[3])
        .when(score >= middle, TIER_ORDER[2])
        .when(score >= low, TIER_ORDER[1])
        .otherwise(TIER_ORDER[0])
    )


def assign_tier(df: DataFrame, mode: str = "percentile", cutoffs: DataFrame | None = None) -> DataFrame:
    """Add ``recommended_action``.

    ``percentile`` compares the two-digit score with quantiles of ``cutoffs``
    (of ``df`` itself by default); ``fixed`` compares the one-digit score with
    25, 50 and 75.
    """
    if mode == "fixed":
        one_digit = F.bround(F.col("probability_of_default").cast("double") * 100, 1)
        action = _tier(one_digit, *[F.lit(c) for c in FIXED_CUTOFFS])
    elif mode == "percentile":
        cuts = (tier_cutoffs(df) if cutoffs is None else cutoffs).scalar()
        action = _tier(F.col("risk_score").cast("double"), cuts[0], cuts[1], cuts[2])
    else:
        raise ValueError(f"unknown tier mode: {mode}")
    return df.withColumn("recommended_action", action)


def expected_loss(df: DataFrame, lgd: float = LGD) -> DataFrame:
    """Add ``expected_loss`` = PD x LGD x exposure in whole cents, and the ``lgd_assumption`` it is based on.

    A stored decimal PD is multiplied exactly; a model's double PD is used unrounded.
    """
    pd = F.col("probability_of_default")
    if isinstance(df.schema["probability_of_default"].dataType, T.DecimalType):
        loss = pd * F.lit(lgd).cast("decimal(4,2)") * F.col("exposure_at_default").cast("decimal(12,2)")
    else:
        loss = pd * F.lit(lgd) * F.col("exposure_at_default").cast("double")
    return df.withColumns(
        {"expected_loss": F.round(loss, 2).cast("decimal(12,2)"), "lgd_assumption": F.lit(lgd).cast("decimal(4,2)")}
    )


def class_decision(pd: Column, threshold: float = 0.5) -> Column:
    return (pd.cast("double") > threshold).cast("int")
