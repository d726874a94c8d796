"""A loan book derived from the sample tables ``customer nation orders lineitem``.

Pseudo-random fields use integer arithmetic only, so that any engine computes
the same book.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanloom.schemas import CUSTOMERS, LOANS, REPAYMENTS, enforce_schema


@dataclass(frozen=True)
class LoanBook:
    customers: DataFrame
    loans: DataFrame
    repayments: DataFrame


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = _read(spark, sf_dir, "nation")
    mapped = (
        _read(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.when(F.col("c_acctbal") <= 0, F.lit(0.0)).otherwise(F.col("c_acctbal") * 20).alias("annual_income"),
            F.expr("case when c_custkey % 12 = 11 then null else c_custkey % 11 end").alias("employment_length"),
            F.col("n_name").alias("region"),
            F.expr(
                "case when c_custkey % 97 = 0 then cast(999 as double)"
                " else cast((c_custkey * 37) % 600 as double) / 10 end"
            ).alias("dti"),
            F.col("c_mktsegment").alias("home_ownership"),
        )
    )
    return enforce_schema(mapped, CUSTOMERS)


def loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    grade = F.expr("substr('ABCDEFG', cast(1 + o_custkey % 7 as int), 1)")
    mapped = _read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("loan_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").alias("loan_amount"),
        F.expr("cast(50 + 35 * (o_custkey % 7) + (o_orderkey * 13) % 30 as double) / 10").alias("interest_rate"),
        F.expr("case when o_orderkey % 3 = 0 then 60 else 36 end").alias("term_months"),
        grade.alias("grade"),
        F.concat(grade, F.expr("cast(1 + o_orderkey % 5 as string)")).alias("sub_grade"),
        F.expr("case when o_orderkey % 499 = 0 then 'renewable_energy' else o_orderpriority end").alias("purpose"),
        F.expr("case when o_orderkey % 1009 = 0 then null else cast(o_orderdate as date) end").alias("issue_date"),
        F.expr(
            "case when (o_orderkey * 7919 + o_custkey * 31) % 100 < 8 + 4 * (o_custkey % 7) then 1 else 0 end"
        ).alias("default_flag"),
    )
    return enforce_schema(mapped, LOANS)


def repayments(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapped = (
        _read(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("loan_id"))
        .agg(
            F.max("l_shipdate").cast("date").alias("payment_date"),
            F.sum(F.col("l_extendedprice").cast("decimal(12,2)")).alias("amount_paid"),
            F.max(F.expr("case when l_returnflag = 'R' and l_discount >= 0.08 then 1 else 0 end")).alias("days_late"),
        )
    )
    return enforce_schema(mapped, REPAYMENTS)


def book(spark: SparkSession, sf_dir: str) -> LoanBook:
    return LoanBook(customers(spark, sf_dir), loans(spark, sf_dir), repayments(spark, sf_dir))


def formula_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores by formula for every loan whose income and dti survive cleaning; needs no model."""
    cust = customers(spark, sf_dir).filter((F.col("annual_income") > 0) & (F.col("dti") < 100))
    pd = F.expr(
        "cast(cast(4 + 4 * (customer_id % 7) + (loan_id * 17) % 9 as double) / 100 as decimal(6,5))"
    )
    return (
        loans(spark, sf_dir)
        .join(cust.select("customer_id"), "customer_id")
        .select(
            "loan_id",
            pd.alias("probability_of_default"),
            F.bround(pd * 100, 2).cast("decimal(5,2)").alias("risk_score"),
            F.col("loan_amount").alias("exposure_at_default"),
        )
    )


def macro(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A monthly unemployment series over the months in which orders exist."""
    month = F.trunc(F.col("o_orderdate").cast("date"), "month").alias("observation_date")
    return (
        _read(spark, sf_dir, "orders")
        .select(month)
        .distinct()
        .select(
            "observation_date",
            (
                4
                + ((F.year("observation_date") * 7) % 25) / F.lit(10.0)
                + (F.month("observation_date") % 4) / F.lit(20.0)
            ).alias("value"),
        )
    )


def hypotheticals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One hypothetical loan per customer, with rates that may lie outside the grade's range."""
    return _read(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("hypothetical_id"),
        F.expr("cast(500 + (c_custkey * 7919) % 450000 as decimal(12,2))").alias("loan_amount"),
        F.expr("cast(cast(50 + (c_custkey * 53) % 260 as double) / 10 as decimal(5,2))").alias("interest_rate"),
        F.expr("case when c_custkey % 2 = 0 then 36 else 60 end").alias("term_months"),
        F.expr("cast(cast((c_custkey * 37) % 600 as double) / 10 as decimal(5,2))").alias("dti"),
        F.expr("cast(case when c_acctbal <= 0 then 0.0 else c_acctbal * 20 end as decimal(12,2))").alias(
            "annual_income"
        ),
        F.expr("cast(c_custkey % 11 as int)").alias("employment_length"),
        F.expr("substr('ABCDEFG', cast(1 + (c_custkey * 3) % 7 as int), 1)").alias("grade"),
        F.col("c_mktsegment").alias("home_ownership"),
        F.expr(
            "element_at(array('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW'),"
            " cast(1 + c_custkey % 5 as int))"
        ).alias("purpose"),
    )


def raw_file_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The book in the raw file's text form, unresolved statuses included, next to its order key."""
    o = _read(spark, sf_dir, "orders")
    c = customers(spark, sf_dir).drop("age", "created_at")
    late = _read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.max("l_shipdate").cast("date").alias("last_date"),
        F.sum(F.col("l_extendedprice").cast("decimal(12,2)")).alias("last_amount"),
        F.sum(F.expr("case when l_returnflag = 'R' and l_discount >= 0.08 then 1 else 0 end")).alias("delinquencies"),
    )
    status = F.expr(
        "case when o_orderkey % 11 = 3 then 'Current'"
        " when (o_orderkey * 7919 + o_custkey * 31) % 100 < 8 + 4 * (o_custkey % 7)"
        " then case when o_orderkey % 2 = 0 then 'Charged Off' else 'Default' end"
        " else 'Fully Paid' end"
    )
    grade = F.expr("substr('ABCDEFG', cast(1 + o_custkey % 7 as int), 1)")
    return (
        o.join(c, o["o_custkey"] == c["customer_id"])
        .join(late, o["o_orderkey"] == late["l_orderkey"], "left")
        .select(
            F.col("o_orderkey").alias("loan_id"),
            F.col("annual_income").cast("double").alias("annual_inc"),
            F.expr(
                "case when o_custkey % 12 = 11 then 'n/a' when o_custkey % 11 = 0 then '< 1 year'"
                " when o_custkey % 11 = 10 then '10+ years'"
                " else concat(cast(o_custkey % 11 as string), ' years') end"
            ).alias("emp_length"),
            F.col("region").alias("addr_state"),
            F.col("dti").cast("double").alias("dti"),
            "home_ownership",
            F.col("o_totalprice").alias("loan_amnt"),
            F.expr(
                "concat(cast(cast(cast(50 + 35 * (o_custkey % 7) + (o_orderkey * 13) % 30 as double) / 10"
                " as decimal(5,1)) as string), '%')"
            ).alias("int_rate"),
            F.expr("case when o_orderkey % 3 = 0 then ' 60 months' else ' 36 months' end").alias("term"),
            grade.alias("grade"),
            F.concat(grade, F.expr("cast(1 + o_orderkey % 5 as string)")).alias("sub_grade"),
            F.col("o_orderpriority").alias("purpose"),
            F.expr(
                "case when o_orderkey % 1009 = 0 then 'unknown'"
                " else date_format(o_orderdate, 'MMM-yyyy') end"
            ).alias("issue_d"),
            status.alias("loan_status"),
            F.col("last_amount").cast("double").alias("total_pymnt"),
            F.date_format("last_date", "MMM-yyyy").alias("last_pymnt_d"),
            F.col("last_amount").cast("double").alias("last_pymnt_amnt"),
            F.col("delinquencies").cast("double").alias("delinq_2yrs"),
            F.lit(0.0).alias("total_rec_late_fee"),
        )
    )
