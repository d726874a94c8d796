"""Raw loan file -> customers, loans and repayments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanloom.functions.columns import first_number, month_year_date, percent_number
from loanloom.functions.shared import materialise
from loanloom.schemas import CUSTOMERS, LOANS, REPAYMENTS, enforce_schema

# The columns of the raw file that are used, in file order.
RAW_COLUMNS = [
    "annual_inc", "emp_length", "addr_state", "dti", "home_ownership",
    "loan_amnt", "int_rate", "term", "grade", "sub_grade", "purpose",
    "issue_d", "loan_status",
    "total_pymnt", "last_pymnt_d", "last_pymnt_amnt",
    "delinq_2yrs", "total_rec_late_fee",
]

# Statuses of loans whose outcome is known, and those that count as a default.
RESOLVED_STATUSES = ["Fully Paid", "Charged Off", "Default"]
DEFAULT_STATUSES = ["Charged Off", "Default"]

# Texts that stand for a missing value in the raw file.
MISSING_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

_NUMBERS = {
    "annual_inc", "dti", "loan_amnt", "total_pymnt", "last_pymnt_amnt", "delinq_2yrs", "total_rec_late_fee",
}


def read_raw_loans(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """The used columns of a headed CSV, matched by header name.

    No type inference, so the file is read once; the header line alone is
    looked at to place the columns, and unused ones are pruned in the scan.
    A file whose header differs from that one stops the load.
    ``multi_line`` reads files whose quoted texts contain line breaks, at the
    price of one task per file.
    """
    options = {"header": True, "quote": '"', "escape": '"', "multiLine": multi_line, "enforceSchema": False}
    header = spark.read.options(**options).csv(path).columns
    missing = [c for c in RAW_COLUMNS if c not in header]
    if missing:
        raise ValueError(f"raw loan file lacks columns: {missing}")
    layout = T.StructType(
        [T.StructField(c, T.DoubleType() if c in _NUMBERS else T.StringType()) for c in header]
    )
    rows = spark.read.schema(layout).options(**options).csv(path)

    def field(c: str) -> Column:
        return F.col(c) if c in _NUMBERS else F.when(~F.col(c).isin(*MISSING_TEXTS), F.col(c)).alias(c)

    return rows.select(*[field(c) for c in RAW_COLUMNS])


_CORRUPT = "__record"


def read_checked_loans(spark: SparkSession, path: str, multi_line: bool = False) -> tuple[DataFrame, DataFrame]:
    """``read_raw_loans`` with its errors made visible: (good rows, rejects).

    A record with too few or too many fields, or with a quote that is never closed, and one whose number is no
    number are rejected whole: one row of ``record`` (the text as it stands, or its used fields), ``reasons`` and
    ``file``. Texts that stand for a missing value are no errors, nor are dates that cannot be read. Every record is
    in one of the two. Both are plans over the same file; store them side by side.
    """
    options = {"header": True, "quote": '"', "escape": '"', "multiLine": multi_line, "enforceSchema": False}
    header = spark.read.options(**options).csv(path).columns
    missing = [c for c in RAW_COLUMNS if c not in header]
    if missing:
        raise ValueError(f"raw loan file lacks columns: {missing}")
    layout = T.StructType([T.StructField(c, T.StringType()) for c in [*header, _CORRUPT]])
    # Without pruning every field of a record is counted.
    options |= {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT, "columnPruning": False}
    texts = spark.read.schema(layout).options(**options).csv(path)

    def known(c: str) -> Column:
        return F.when(~F.trim(c).isin(*MISSING_TEXTS), F.col(c))

    numbers = {c: known(c).try_cast("double") for c in _NUMBERS}
    readings = numbers | {"int_rate": percent_number(known("int_rate")), "term": first_number(known("term"))}
    wrong = [
        F.when(known(c).isNotNull() & readings[c].isNull(), F.lit(f"{c}: no number")) for c in RAW_COLUMNS if c in readings
    ]
    reasons = F.when(F.col(_CORRUPT).isNotNull(), F.array(F.lit("malformed record"))).otherwise(F.array_compact(F.array(*wrong)))
    judged = texts.withColumn("__reasons", reasons)
    good = judged.filter(F.size("__reasons") == 0).select(*[numbers.get(c, known(c)).alias(c) for c in RAW_COLUMNS])
    rejects = judged.filter(F.size("__reasons") > 0).select(
        F.coalesce(_CORRUPT, F.to_csv(F.struct(*RAW_COLUMNS))).alias("record"),
        F.col("__reasons").alias("reasons"),
        F.col("_metadata.file_path").alias("file"),
    )
    return good, rejects


def reject_counts(rejects: DataFrame) -> DataFrame:
    """``reason, n_records``; a record with two wrong fields counts for both."""
    return rejects.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count("*").alias("n_records"))


def filter_resolved(raw: DataFrame, statuses: Sequence[str] = tuple(RESOLVED_STATUSES)) -> DataFrame:
    return raw.filter(F.col("loan_status").isin(*statuses))


def stage(raw: DataFrame, path: str) -> DataFrame:
    """Write the selected raw rows once; ids are read off the written files."""
    raw.write.mode("overwrite").parquet(path)
    return raw.sparkSession.read.parquet(path)


def assign_ids(staged: DataFrame, id_col: str = "loan_id", after: int = 0) -> DataFrame:
    """Dense ids ``after`` + 1..``after`` + n for a DataFrame read from Parquet files.

    A row's id is its position in its file plus the rows of all earlier files,
    so no row moves between tasks, and the ids are the same on every re-read,
    also after a lost executor. Only one count per file is aggregated.
    """
    located = staged.select(
        "*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row")
    )
    per_file = located.groupBy("__file").agg(F.count("*").alias("n"))
    before = Window.orderBy("__file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_file.select("__file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__offset"))
    return (
        located.join(materialise(offsets), "__file")
        .withColumn(id_col, F.col("__offset") + F.col("__row") + 1 + after)
        .drop("__file", "__row", "__offset")
    )


def normalize(raw: DataFrame, id_col: str = "loan_id", dated: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Split raw records with an id into the three base tables; one customer per loan.

    ``dated`` repayments carry the ``issue_date`` of their loan, by which they can be stored.
    """
    loan_id = F.col(id_col)
    customers = raw.select(
        loan_id.alias("customer_id"),
        F.col("annual_inc").alias("annual_income"),
        first_number(F.col("emp_length")).alias("employment_length"),
        F.col("addr_state").alias("region"),
        F.col("dti").alias("dti"),
        "home_ownership",
    )
    loans = raw.select(
        loan_id.alias("loan_id"),
        loan_id.alias("customer_id"),
        F.col("loan_amnt").alias("loan_amount"),
        percent_number(F.col("int_rate")).alias("interest_rate"),
        first_number(F.col("term")).alias("term_months"),
        "grade",
        "sub_grade",
        "purpose",
        month_year_date(F.col("issue_d")).alias("issue_date"),
        F.coalesce(F.col("loan_status").isin(*DEFAULT_STATUSES), F.lit(False)).cast("int").alias("default_flag"),
    )
    if dated:
        repayments = raw.select(month_year_date(F.col("issue_d")).alias("issue_date"), *_repayment_columns(loan_id))
    else:
        repayments = enforce_schema(raw.select(*_repayment_columns(loan_id)), REPAYMENTS)
    return enforce_schema(customers, CUSTOMERS), enforce_schema(loans, LOANS), repayments


def _repayment_columns(loan_id: Column) -> list[Column]:
    return [
        loan_id.alias("loan_id"),
        month_year_date(F.col("last_pymnt_d")).alias("payment_date"),
        F.col("last_pymnt_amnt").alias("amount_paid"),
        (F.coalesce(F.col("delinq_2yrs"), F.lit(0.0)) > 0).cast("int").alias("days_late"),
    ]
