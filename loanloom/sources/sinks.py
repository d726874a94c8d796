"""Writers: append, replace, keyed upsert, score write-back and export."""

from __future__ import annotations

import datetime
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanloom.operators.decision import LGD
from loanloom.schemas import LOANS, REPAYMENTS, RISK_SCORES, enforce_schema
from loanloom.sources.key_index import build_key_index
from loanloom.sources.versions import read_keyed, upsert


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def overwrite(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def truncate(df: DataFrame, path: str) -> None:
    """Empty a table and keep its schema."""
    overwrite(df.limit(0), path)


def merge_rows(existing: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``existing`` with the rows of ``new`` replacing those that share a key."""
    return existing.join(new.select(*keys), list(keys), "left_anti").unionByName(new)


def write_loans(loans: DataFrame, path: str) -> None:
    """Partition by origination year and sort by date inside, so date ranges skip files and row groups.

    The extra hash of the id in the repartition spreads one large year over many tasks.
    """
    tasks = loans.sparkSession.conf.get("spark.sql.shuffle.partitions")
    spread = F.pmod(F.xxhash64("loan_id"), F.lit(int(tasks)))
    (
        enforce_schema(loans, LOANS)
        .withColumn("origination_year", F.year("issue_date"))
        .repartition(F.col("origination_year"), spread)
        .sortWithinPartitions("origination_year", "issue_date")
        .write.mode("overwrite")
        .partitionBy("origination_year")
        .parquet(path)
    )


_BLOOM = {"parquet.bloom.filter.enabled#loan_id": "true"}


def write_repayments(repayments: DataFrame, path: str) -> None:
    """Sorted by loan inside files, so a point lookup reads the row groups of one loan.

    Rows that carry their loan's ``issue_date`` are partitioned by origination year as loans are, so a range of
    issue dates prunes both tables; the date itself is not stored. A key index and Bloom filters on ``loan_id`` go with
    the files, for ``indexed_lookup`` and for plain filters.
    """
    if "issue_date" not in repayments.columns:
        typed = enforce_schema(repayments, REPAYMENTS)
        ordered = typed.repartitionByRange("loan_id").sortWithinPartitions("loan_id")
        ordered.write.mode("overwrite").options(**_BLOOM).parquet(path)
        build_key_index(repayments.sparkSession, path, "loan_id", REPAYMENTS)
        return
    year = F.year("issue_date").alias("origination_year")
    dated = repayments.select("*", year)
    typed = dated.select(*[F.col(f.name).cast(f.dataType) for f in REPAYMENTS.fields], "origination_year")
    ordered = typed.repartitionByRange("origination_year", "loan_id").sortWithinPartitions("origination_year", "loan_id")
    ordered.write.mode("overwrite").options(**_BLOOM).partitionBy("origination_year").parquet(path)
    build_key_index(repayments.sparkSession, path, "loan_id", REPAYMENTS)


def save_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> DataFrame:
    """Store as a catalog table hashed and sorted by ``key``; tables bucketed alike join on it without a shuffle."""
    spark = df.sparkSession
    (
        df.repartition(buckets, F.col(key))
        .write.mode("overwrite")
        .format("parquet")
        .bucketBy(buckets, key)
        .sortBy(key)
        .saveAsTable(table)
    )
    return spark.table(table)


def write_scores(
    scored: DataFrame,
    path: str,
    model_version: str,
    prediction_date: datetime.date | None = None,
    lgd: float = LGD,
) -> None:
    """Store scored loans under their model version; scoring again replaces that version.

    A column ``lgd_assumption``, as ``expected_loss`` adds it, is stored; ``lgd`` is for rows without one.
    Files are ranges of loans, so a lookup by loan reads few row groups.
    """
    stamp: Column = F.current_date() if prediction_date is None else F.lit(prediction_date)
    rows = scored.withColumns(
        {
            "model_version": F.lit(model_version),
            "prediction_date": stamp,
            "lgd_assumption": F.col("lgd_assumption") if "lgd_assumption" in scored.columns else F.lit(lgd),
        }
    )
    typed = enforce_schema(rows, RISK_SCORES)
    extra = [c for c in ("top_drivers",) if c in scored.columns]
    if extra:
        typed = rows.select(*[F.col(f.name).cast(f.dataType) for f in RISK_SCORES.fields], *extra)
    upsert(typed.repartitionByRange("loan_id").sortWithinPartitions("loan_id"), path, ["model_version"])


def export_tables(tables: Mapping[str, DataFrame], out_dir: str, fmt: str = "parquet") -> dict[str, str]:
    """Write every table below ``out_dir`` as parquet, or as headed CSV."""
    written = {}
    for name, df in tables.items():
        target = f"{out_dir.rstrip('/')}/{name}"
        writer = df.write.mode("overwrite")
        if fmt == "csv":
            writer = writer.option("header", True)
        writer.format(fmt).save(target)
        written[name] = target
    return written


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    """Stored scores with their declared types, the version column included."""
    return read_keyed(spark, path, RISK_SCORES)
