"""Typed tables of the loan book and the helpers that enforce them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _table(*fields: tuple[str, T.DataType] | tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(f[0], f[1], f[2] if len(f) > 2 else True) for f in fields])


def _decimal(precision: int, scale: int) -> T.DecimalType:
    return T.DecimalType(precision, scale)


# The columns of each table and their types.
CUSTOMERS = _table(
    ("customer_id", T.LongType(), False),
    ("age", T.IntegerType()),
    ("annual_income", _decimal(12, 2)),
    ("employment_length", T.IntegerType()),
    ("region", T.StringType()),
    ("dti", _decimal(5, 2)),
    ("home_ownership", T.StringType()),
    ("created_at", T.TimestampType()),
)

LOANS = _table(
    ("loan_id", T.LongType(), False),
    ("customer_id", T.LongType(), False),
    ("loan_amount", _decimal(12, 2)),
    ("interest_rate", _decimal(5, 2)),
    ("term_months", T.IntegerType()),
    ("grade", T.StringType()),
    ("sub_grade", T.StringType()),
    ("purpose", T.StringType()),
    ("issue_date", T.DateType()),
    ("default_flag", T.IntegerType()),
)

REPAYMENTS = _table(
    ("loan_id", T.LongType(), False),
    ("payment_date", T.DateType()),
    ("amount_paid", _decimal(12, 2)),
    # A 0/1 "had a delinquency" mark, not a number of days.
    ("days_late", T.IntegerType()),
)

RISK_SCORES = _table(
    ("loan_id", T.LongType(), False),
    ("model_version", T.StringType()),
    ("risk_score", _decimal(5, 2)),
    ("probability_of_default", _decimal(6, 5)),
    ("lgd_assumption", _decimal(4, 2)),
    ("exposure_at_default", _decimal(12, 2)),
    ("expected_loss", _decimal(12, 2)),
    ("prediction_date", T.DateType()),
    ("recommended_action", T.StringType()),
)

# The columns risk_scores gained when expected loss was introduced.
EXPECTED_LOSS_COLUMNS = T.StructType(
    [RISK_SCORES[c] for c in ("probability_of_default", "lgd_assumption", "exposure_at_default", "expected_loss")]
)

MODEL_MONITORING = _table(
    ("model_version", T.StringType(), False),
    ("trained_date", T.DateType()),
    ("accuracy", _decimal(5, 4)),
    ("precision_score", _decimal(5, 4)),
    ("recall_score", _decimal(5, 4)),
    ("roc_auc", _decimal(5, 4)),
    ("notes", T.StringType()),
)

STRESS_TEST_RESULTS = _table(
    ("scenario", T.StringType(), False),
    ("unemployment_delta_pp", _decimal(4, 2)),
    ("scenario_source", T.StringType()),
    ("portfolio_el", _decimal(14, 2)),
    ("pd_sensitivity_slope", _decimal(8, 5)),
    ("sensitivity_r_squared", _decimal(5, 4)),
    ("sensitivity_ci_lower", _decimal(8, 5)),
    ("sensitivity_ci_upper", _decimal(8, 5)),
    ("applied_sensitivity_pp", _decimal(8, 5)),
    ("n_years_fitted", T.IntegerType()),
    ("run_date", T.DateType()),
)

TABLES = {
    "customers": CUSTOMERS,
    "loans": LOANS,
    "repayments": REPAYMENTS,
    "risk_scores": RISK_SCORES,
    "model_monitoring": MODEL_MONITORING,
    "stress_test_results": STRESS_TEST_RESULTS,
}

# Values a column takes when a row is written without one.
DEFAULTS = {
    "created_at": F.current_timestamp,
    "default_flag": lambda: F.lit(0),
    "days_late": lambda: F.lit(0),
}


def enforce_schema(df: DataFrame, schema: T.StructType, strict: bool = True) -> DataFrame:
    """Select and cast ``df`` to ``schema``; absent columns become their default or NULL, a given NULL stays one.

    A value its column cannot hold stops a strict load and becomes NULL otherwise.
    """
    present = set(df.columns)

    def field(f: T.StructField) -> Column:
        value = F.col(f.name) if f.name in present else F.lit(None)
        value = value.cast(f.dataType) if strict else value.try_cast(f.dataType)
        if f.name in DEFAULTS and f.name not in present:
            value = DEFAULTS[f.name]().cast(f.dataType)
        return value.alias(f.name)

    return df.select(*[field(f) for f in schema.fields])


def add_columns(df: DataFrame, fields: Iterable[T.StructField]) -> DataFrame:
    """Append typed NULL columns that ``df`` does not have yet."""
    new = {f.name: F.lit(None).cast(f.dataType) for f in fields if f.name not in df.columns}
    return df.withColumns(new) if new else df
