"""Views as SQL text: alike with the DataFrame forms, and always as new as their tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from loanloom.plans.sql_views import PEER_BASE, create_views, view_texts
from loanloom.plans.views import VIEW_NAMES, build_views
from loanloom.schemas import CUSTOMERS, LOANS, REPAYMENTS
from loanloom.sources import sample_book, sinks

SF = "/root/testdata/sf0.001"


def _rows(df):
    digits = [F.round(F.col(c).cast("double"), 9).alias(c) if t in ("double", "decimal(12,2)") else F.col(c) for c, t in df.dtypes]
    return sorted(map(tuple, df.select(*digits).collect()), key=repr)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root, b = tmp_path_factory.mktemp("views"), sample_book.book(spark, SF)
    # Rows of every odd kind: no rate, no amount, no grade, no outcome, no date, one loan alone in its grade and region.
    odd = [
        (10**9 + 1, 1, None, 9.5, 36, "A", "A1", "car", None, 1), (10**9 + 2, 2, 5000.0, None, 36, "A", "A1", "car", None, 0),
        (10**9 + 3, 3, 5000.0, 9.5, 60, None, None, None, None, None), (10**9 + 4, 10**9, 7000.0, 30.0, 36, "Z", "Z1", "car", None, None),
    ]
    more = spark.createDataFrame(odd, "loan_id long, customer_id long, loan_amount double, interest_rate double, term_months int, grade string, sub_grade string, purpose string, issue_date date, default_flag int")
    alone = spark.createDataFrame([(10**9, 50000.0, "NOWHERE")], "customer_id long, annual_income double, region string")
    typed = more.select(*[F.col(f.name).cast(f.dataType) for f in LOANS])
    borrower = alone.select(*[(F.col(f.name) if f.name in alone.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in CUSTOMERS])
    loans = b.loans.select(*[F.col(f.name).cast(f.dataType) for f in LOANS])
    customers = b.customers.select(*[F.col(f.name).cast(f.dataType) for f in CUSTOMERS])
    repayments = b.repayments.select(*[F.col(f.name).cast(f.dataType) for f in REPAYMENTS])
    sinks.overwrite(loans.unionByName(typed), f"{root}/loans")
    sinks.overwrite(customers.unionByName(borrower), f"{root}/customers")
    sinks.overwrite(repayments, f"{root}/repayments")
    return {n: f"{root}/{n}" for n in ("loans", "customers", "repayments")}


@pytest.mark.parametrize("view", VIEW_NAMES)
def test_texts_say_what_the_frames_say(spark, tables, view):
    create_views(spark, tables)
    frames = build_views(*[spark.read.parquet(tables[n]) for n in ("loans", "customers", "repayments")])
    got = spark.table(view)
    assert got.columns == frames[view].columns and _rows(got) == _rows(frames[view])


def test_views_follow_their_tables(spark, tables, tmp_path):
    own = {n: str(tmp_path / n) for n in tables}
    for n, path in tables.items():
        sinks.overwrite(spark.read.parquet(path), own[n])
    names = create_views(spark, own)
    before = {v: _rows(spark.table(v)) for v in names}
    first = spark.read.parquet(tables["loans"]).filter("loan_id < 1000000000").withColumn("loan_id", F.col("loan_id") + 2 * 10**9)
    sinks.append(first, own["loans"])
    sinks.append(spark.read.parquet(tables["repayments"]).withColumn("loan_id", F.col("loan_id") + 2 * 10**9), own["repayments"])
    after = {v: _rows(spark.table(v)) for v in names}
    assert all(after[v] != before[v] for v in names if v not in ("customers",))
    # Twice the loans: the same shares, the ranks pushed down.
    ranks = [{r[0]: r[-1] for r in rows["loan_peer_benchmark_features"] if r[0] < 10**9} for rows in (before, after)]
    assert len(ranks[0]) == len(ranks[1]) and all(ranks[1][k] >= ranks[0][k] for k in ranks[0]) and ranks[0] != ranks[1]


def test_no_view_sorts_a_whole_grade(spark, tables):
    create_views(spark, tables)
    windows = [line for line in spark.table(PEER_BASE)._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Window [" in line]
    assert windows and all("loan_id" not in w for w in windows)
    assert set(VIEW_NAMES) < set(view_texts())
