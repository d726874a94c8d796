"""The named views of the loan book."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from loanloom.operators.features import (
    PEER_COLUMNS,
    final_model_features,
    loan_base_features,
    with_peer_benchmarks,
)
from loanloom.operators.portfolio import monthly_default_trend, yearly_origination_quality
from loanloom.operators.vintage import CRISIS_YEARS, vintage_analysis, vintage_loan_base

VIEW_NAMES = (
    "loan_base_features",
    "loan_peer_benchmark_features",
    "monthly_default_trend",
    "final_model_features",
    "vintage_loan_base",
    "vintage_analysis",
    "yearly_origination_quality",
)


def build_views(
    loans: DataFrame, customers: DataFrame, repayments: DataFrame, crisis_years: Sequence[int] = CRISIS_YEARS
) -> dict[str, DataFrame]:
    """All views as lazy DataFrames. Only the peers' counts per distinct value are computed up front."""
    base = loan_base_features(loans, customers, repayments)
    peers = with_peer_benchmarks(base)
    vintage = vintage_loan_base(loans, repayments)
    return {
        "loan_base_features": base,
        "loan_peer_benchmark_features": peers.select(
            "loan_id", "grade", "region", "issue_date", "interest_rate", "default_flag", *PEER_COLUMNS
        ),
        "monthly_default_trend": monthly_default_trend(loans),
        "final_model_features": final_model_features(peers),
        "vintage_loan_base": vintage,
        "vintage_analysis": vintage_analysis(vintage, crisis_years=crisis_years),
        "yearly_origination_quality": yearly_origination_quality(loans),
    }


def register_views(
    spark: SparkSession,
    loans: DataFrame,
    customers: DataFrame,
    repayments: DataFrame,
    crisis_years: Sequence[int] = CRISIS_YEARS,
) -> list[str]:
    """Create or replace the tables and views for ``spark.sql``."""
    tables = {"loans": loans, "customers": customers, "repayments": repayments}
    for name, df in {**tables, **build_views(loans, customers, repayments, crisis_years)}.items():
        df.createOrReplaceTempView(name)
    return [*tables, *VIEW_NAMES]
