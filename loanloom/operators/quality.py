"""Profiling, cleaning and data audits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanloom.functions.columns import clip
from loanloom.functions.ordered import exact_quantiles, money_bucket, quantiles_of_counts
from loanloom.functions.shared import materialise
from loanloom.operators.features import loan_to_income


def null_report(df: DataFrame) -> DataFrame:
    """Columns that have NULLs, with how many; one pass over ``df``."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], list(df.columns), "column", "n_null").filter("n_null > 0")


def class_balance(df: DataFrame, column: str = "default_flag", digits: int = 4) -> DataFrame:
    """Share of rows per value of ``column``, NULLs left out."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("n")).scalar()
    return counts.select(column, F.round(F.col("n") / total, digits).alias("share"))


def numeric_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """mean, sample standard deviation, min and max, one row per column; one pass over ``df``."""

    def stats(c: str) -> Column:
        v = F.col(c).cast("double")
        return F.struct(
            F.lit(c).alias("column"),
            F.avg(v).alias("mean"),
            F.stddev_samp(v).alias("std"),
            F.min(v).alias("min"),
            F.max(v).alias("max"),
        ).alias(c)

    row = df.agg(*[stats(c) for c in columns])
    return row.select(F.inline(F.array(*[F.col(c) for c in columns])))


def income_cap(df: DataFrame, column: str = "annual_income", q: float = 0.99, exact: bool = True) -> Column:
    """The ``q`` quantile as a scalar; the approximate form trades exactness for a fixed-size sketch."""
    if exact:
        return exact_quantiles(df, column, [q], money_bucket(F.col(column))).scalar()[0]
    return df.agg(F.percentile_approx(F.col(column).cast("double"), F.lit(q), F.lit(10000)).alias("cap")).scalar()


def winsorize(df: DataFrame, column: str, q: float = 0.99, exact: bool = True) -> DataFrame:
    """Cap ``column`` at its ``q`` quantile; NULL stays NULL."""
    return df.withColumn(column, clip(F.col(column).cast("double"), upper=income_cap(df, column, q, exact)))


def category_counts(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))


def rare_categories(df: DataFrame, column: str, min_count: int = 200) -> DataFrame:
    return category_counts(df, column).filter(F.col("n") < min_count)


def group_rare(
    df: DataFrame, column: str, min_count: int = 200, other: str = "other", rare: DataFrame | None = None
) -> DataFrame:
    """Replace categories with fewer than ``min_count`` rows by ``other``; NULL stays NULL."""
    rare = materialise(rare_categories(df, column, min_count).select(column)) if rare is None else rare
    marked = df.join(rare.select(column, F.lit(True).alias("__rare")), column, "left")
    return marked.withColumn(column, F.when(F.col("__rare"), F.lit(other)).otherwise(F.col(column))).select(
        *df.columns
    )


_USABLE, _KEPT = "__usable", "__kept"


def clean(
    df: DataFrame, income_quantile: float = 0.99, max_dti: float = 100, min_purpose: int = 200
) -> tuple[DataFrame, DataFrame]:
    """Model table -> (cleaned table, one-row report of what was dropped, capped and regrouped).

    Missing employment length becomes 0; rows without usable income or with a
    placeholder dti go; income is capped; the loan/income ratio is recomputed;
    rare purposes become "other". ``df`` is evaluated once, into a stored table of its rows with the verdicts on
    them; the cap, the rare purposes, every count of the report and the result are read off that.
    """
    filled = df.fillna(0, subset=["employment_length"])
    usable = F.coalesce(
        (F.col("annual_income") > 0) & F.col("dti").isNotNull() & F.col("loan_to_income_ratio").isNotNull(),
        F.lit(False),
    )
    real_dti = F.coalesce(F.col("dti") < max_dti, F.lit(False))
    stored = materialise(filled.withColumns({_USABLE: usable, _KEPT: usable & real_dti}))

    # Rows per (kept, income), per (kept, purpose) and per reason for dropping.
    profile = materialise(
        stored.select("annual_income", "purpose", _USABLE, _KEPT)
        .groupingSets(
            [[_KEPT, "annual_income"], [_KEPT, "purpose"], [_USABLE, _KEPT]], "annual_income", "purpose", _USABLE, _KEPT
        )
        .agg(
            F.count("*").alias("n"),
            F.grouping("annual_income").alias("not_income"),
            F.grouping("purpose").alias("not_purpose"),
        )
    )
    incomes = profile.filter(F.col(_KEPT) & (F.col("not_income") == 0)).select("annual_income", "n")
    purposes = profile.filter(F.col(_KEPT) & (F.col("not_purpose") == 0)).select("purpose", "n")
    reasons = profile.filter("not_income = 1 and not_purpose = 1")
    cut = materialise(
        quantiles_of_counts(incomes, "annual_income", [income_quantile], money_bucket(F.col("annual_income")))
    )
    cap = cut.scalar()[0]
    rare = materialise(purposes.filter((F.col("n") < min_purpose) & F.col("purpose").isNotNull()))

    capped = clip(F.col("annual_income").cast("double"), upper=cap)
    ratio = loan_to_income(F.col("loan_amount"), F.col("annual_income"))
    cleaned = stored.filter(_KEPT).drop(_USABLE, _KEPT).withColumn("annual_income", capped)
    cleaned = group_rare(cleaned.withColumn("loan_to_income_ratio", ratio), "purpose", min_purpose, rare=rare)

    def rows(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    n_capped = incomes.filter(F.col("annual_income").cast("double") > cap).agg(rows(F.lit(True)).alias("n"))
    n_regrouped = rare.agg(rows(F.lit(True)).alias("n"))
    report = reasons.agg(
        rows(F.lit(True)).alias("n_input"),
        rows(~F.col(_USABLE)).alias("n_dropped_income"),
        rows(F.col(_USABLE) & ~F.col(_KEPT)).alias("n_dropped_dti"),
    ).select(
        "*",
        n_capped.scalar().alias("n_capped"),
        cap.alias("income_cap"),
        n_regrouped.scalar().alias("n_regrouped"),
    )
    return cleaned, report


def audit_keys(child: DataFrame, parent: DataFrame, key: str, child_id: str | None = None) -> DataFrame:
    """Violations of ``child.key`` -> ``parent.key`` and of the parent's key, as (check, key, n_rows).

    Both sides are counted per key first, so a hot key is one row in the join.
    """
    references = child.groupBy(F.col(key).alias("key")).agg(F.count("*").alias("n_references"))
    keys = parent.groupBy(F.col(key).alias("key")).agg(F.count("*").alias("n_keys"))
    known, uses, n_keys = F.col("key").isNotNull(), F.col("n_references"), F.col("n_keys")
    checks = {
        "missing parent": (known & n_keys.isNull(), uses),
        "null reference": (~known & uses.isNotNull(), uses),
        "null key": (~known & n_keys.isNotNull(), n_keys),
        "duplicate key": (known & (n_keys > 1), n_keys),
    }
    rows = F.array_compact(
        F.array(
            *[
                F.when(failed, F.struct(F.lit(name).alias("check"), F.col("key").cast("string").alias("key"), n.alias("n_rows")))
                for name, (failed, n) in checks.items()
            ]
        )
    )
    found = references.join(keys, "key", "full_outer").select(F.inline(rows))

    if child_id is not None:
        ids = child.groupBy(F.col(child_id).alias("key")).agg(F.count("*").alias("n_rows"))
        twice = ids.filter("n_rows > 1").select(F.lit("duplicate child").alias("check"), F.col("key").cast("string").alias("key"), "n_rows")
        found = found.unionByName(twice)
    return found


def flag_ood(df: DataFrame, ranges: DataFrame) -> DataFrame:
    """Add the grade's historical rate range and whether the row's rate lies outside it.

    A grade without history has no range and counts as outside.
    """
    known = materialise(ranges.select("grade", "min_rate", "max_rate"))
    inside = F.col("interest_rate").between(F.col("min_rate"), F.col("max_rate"))
    return df.join(known, "grade", "left").withColumn(
        "out_of_distribution", F.when(F.coalesce(inside, F.lit(False)), 0).otherwise(1)
    )
