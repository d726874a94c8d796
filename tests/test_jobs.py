from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from loanloom.functions.shared import shared_folder
from loanloom.operators.portfolio import filter_portfolio, loans_with_payments, point_lookup
from loanloom.plans import jobs
from loanloom.schemas import LOANS, REPAYMENTS, TABLES, enforce_schema
from loanloom.sources import raw_loans, sample_book, sinks
from loanloom.sources.tables import TableCache, read_macro, read_table

SF = "/root/testdata/sf0.001"
STAMP = datetime.date(2024, 5, 1)


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("warehouse")
    rows = sample_book.raw_file_rows(spark, SF).drop("loan_id").withColumn("extra", F.lit("unused"))
    rows.repartition(5).write.option("header", True).csv(f"{root}/loan.csv")
    jobs.ingest(spark, f"{root}/loan.csv", f"{root}/w", sample_size=1000)
    return f"{root}/w"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_ingest_numbers_the_sample_and_shares_ids(spark, warehouse):
    loans = read_table(spark, f"{warehouse}/loans", LOANS)
    customers = spark.read.parquet(f"{warehouse}/customers")
    repayments = spark.read.parquet(f"{warehouse}/repayments")
    for df, key in ((loans, "loan_id"), (customers, "customer_id"), (repayments, "loan_id")):
        assert sorted(r[0] for r in df.select(key).collect()) == list(range(1, 1001))
    assert {f.name: f.dataType for f in customers.schema} == {f.name: f.dataType for f in TABLES["customers"]}
    assert customers.filter("created_at is null").count() == 0
    assert loans.filter("loan_id <> customer_id").count() == 0


def test_reading_needs_every_used_column(spark, tmp_path):
    spark.range(1).write.option("header", True).csv(str(tmp_path / "bad.csv"))
    with pytest.raises(ValueError, match="annual_inc"):
        raw_loans.read_raw_loans(spark, str(tmp_path / "bad.csv"))


def test_quoted_texts_and_missing_marks_are_read_like_a_spreadsheet_export(spark, tmp_path):
    header = ",".join(["desc", *raw_loans.RAW_COLUMNS])
    row = '"said ""yes"",\nthen no",50000,n/a,CA,12.5,RENT,1000, 13.5%, 36 months,A,A1,car,Mar-2015,Default,1,NA,2,,0'
    (tmp_path / "loan.csv").write_text(f"{header}\n{row}\n")
    rows = raw_loans.read_raw_loans(spark, str(tmp_path / "loan.csv"), multi_line=True)
    customers, loans, repayments = raw_loans.normalize(rows.withColumn("loan_id", F.lit(1)))
    customer, loan, payment = customers.first(), loans.first(), repayments.first()
    assert (customer.employment_length, customer.region, float(customer.dti)) == (None, "CA", 12.5)
    assert (float(loan.interest_rate), loan.term_months, loan.default_flag) == (13.5, 36, 1)
    assert (payment.payment_date, payment.days_late) == (None, 0)


def test_values_a_column_cannot_hold(spark):
    rows = spark.createDataFrame([(1, 1234.5)], "customer_id long, dti double")
    assert enforce_schema(rows, TABLES["customers"], strict=False).first().dti is None
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        enforce_schema(rows, TABLES["customers"]).collect()


def test_ids_are_dense_over_many_files_and_stable(spark, tmp_path):
    spark.range(1000).select(F.expr("id % 3").alias("v")).repartition(9).write.parquet(str(tmp_path / "t"))
    numbered = raw_loans.assign_ids(spark.read.parquet(str(tmp_path / "t")), "row_id")
    ids = sorted(r.row_id for r in numbered.collect())
    assert ids == list(range(1, 1001))
    a, b = ({tuple(r) for r in numbered.collect()} for _ in range(2))
    assert a == b


def test_date_range_prunes_years_and_reaches_the_scan(spark, warehouse):
    loans = read_table(spark, f"{warehouse}/loans", LOANS)
    repayments = read_table(spark, f"{warehouse}/repayments", REPAYMENTS)
    plan = _plan(loans_with_payments(loans, repayments, "1997-03-01", "1997-03-07"))
    assert "GreaterThanOrEqual(issue_date" in plan
    scans = plan.split("PartitionFilters")[1:]
    assert len(scans) == 2 and all("origination_year" in s.split("]")[0] for s in scans)
    assert "ReadSchema: struct<loan_id:bigint,loan_amount:decimal(12,2),issue_date:date>" in plan
    assert "EqualTo(loan_id,7)" in _plan(point_lookup(repayments, "loan_id", 7))


def test_tables_bucketed_alike_join_without_a_shuffle(spark):
    loans = sinks.save_bucketed(sample_book.loans(spark, SF), "bucketed_loans", "loan_id", 4)
    repayments = sinks.save_bucketed(sample_book.repayments(spark, SF), "bucketed_repayments", "loan_id", 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = loans_with_payments(loans, repayments, "1995-01-01", "2001-12-31")
        assert "Exchange" not in _plan(joined)
        assert joined.count() > 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("drop table bucketed_loans")
        spark.sql("drop table bucketed_repayments")


def test_train_score_stress_end_to_end(spark, warehouse):
    comparison = {r.model: r for r in jobs.train(spark, warehouse, rounds=3).collect()}
    assert set(comparison) == {"baseline", "trees raw", "trees calibrated"}
    assert comparison["trees calibrated"].roc_auc > 0.5

    for _ in range(2):
        jobs.score_and_explain(spark, warehouse, "v1", run_date=STAMP)
    scores = sinks.read_scores(spark, f"{warehouse}/risk_scores")
    table = spark.read.parquet(f"{warehouse}/model_table")
    assert scores.count() == table.count() == scores.select("loan_id").distinct().count()
    assert spark.read.parquet(f"{warehouse}/risk_scores").filter("top_drivers is null").count() == 0
    monitoring = spark.read.parquet(f"{warehouse}/model_monitoring").collect()
    assert len(monitoring) == 1 and monitoring[0].trained_date == STAMP

    stored = jobs.store_portfolio(spark, warehouse, "v1", files=8)
    assert stored.count() == table.count() and stored.filter("recommended_action is null").count() == 0
    top = filter_portfolio(stored, tier="Manual review").count()
    assert top == scores.filter("recommended_action = 'Manual review'").count()

    macro = sample_book.macro(spark, SF)
    for _ in range(2):
        rows = jobs.stress(spark, warehouse, macro, run_date=STAMP).collect()
    assert {r.scenario for r in rows} == {"baseline", "adverse", "severely_adverse"} and len(rows) == 3


def test_the_model_table_is_split_once_and_by_outcome(spark, warehouse):
    base = spark.read.parquet(f"{warehouse}/base_features")
    peers = spark.read.parquet(f"{warehouse}/peer_features")
    for r in peers.groupBy("default_flag").agg(F.count("*").alias("n"), F.expr("count_if(split = 'train')").alias("train")).collect():
        assert abs(r.train - 0.6 * r.n) <= 0.5
    assert peers.count() == base.count()


def test_ingest_keeps_every_resolved_row_by_default(spark, tmp_path):
    rows = sample_book.raw_file_rows(spark, SF).drop("loan_id")
    rows.write.option("header", True).csv(f"{tmp_path}/loan.csv")
    jobs.ingest(spark, f"{tmp_path}/loan.csv", f"{tmp_path}/w")
    resolved = rows.filter(F.col("loan_status").isin(*raw_loans.RESOLVED_STATUSES)).count()
    assert read_table(spark, f"{tmp_path}/w/loans", LOANS).count() == resolved > 1000


def test_a_file_with_other_columns_order_stops_the_load(spark, tmp_path):
    columns = list(raw_loans.RAW_COLUMNS)
    (tmp_path / "a.csv").write_text(",".join(columns) + "\n" + ",".join(["1000", *["x"] * 2, "10", *["1"] * 14]) + "\n")
    columns[0], columns[3] = columns[3], columns[0]
    (tmp_path / "b.csv").write_text(",".join(columns) + "\n" + ",".join(["10", *["x"] * 2, "1000", *["1"] * 14]) + "\n")
    with pytest.raises(Exception, match="(?i)header"):
        raw_loans.read_raw_loans(spark, str(tmp_path)).collect()


def test_a_given_null_label_stays_unknown(spark):
    row = enforce_schema(spark.createDataFrame([(1, None)], "loan_id long, default_flag int"), LOANS).first()
    assert row.default_flag is None
    assert enforce_schema(spark.range(1).withColumnRenamed("id", "loan_id"), LOANS).first().default_flag == 0


def test_leak_safe_table_differs_from_the_leaky_one(spark, warehouse):
    columns = ["loan_id", "grade_default_rate"]
    leaky = {tuple(r) for r in jobs.build_model_table(spark, warehouse, leak_safe=False).select(*columns).collect()}
    safe = {tuple(r) for r in jobs.build_model_table(spark, warehouse).select(*columns).collect()}
    assert leaky != safe and {i for i, _ in leaky} == {i for i, _ in safe}


def test_macro_file(spark, tmp_path):
    (tmp_path / "unrate.csv").write_text("observation_date,UNRATE\n2010-01-01,9.8\n2010-02-01,\n")
    rows = read_macro(spark, str(tmp_path / "unrate.csv")).collect()
    assert [(r.observation_date, r.value) for r in rows] == [
        (datetime.date(2010, 1, 1), 9.8), (datetime.date(2010, 2, 1), None),
    ]


def test_csv_export_reads_back(spark, tmp_path):
    rows = sample_book.repayments(spark, SF)
    paths = sinks.export_tables({"repayments": rows}, str(tmp_path), "csv")
    back = enforce_schema(spark.read.option("header", True).csv(paths["repayments"]), REPAYMENTS)
    assert {tuple(r) for r in back.collect()} == {tuple(r) for r in rows.collect()}


def test_cached_reads_are_refreshed_after_their_time(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    held, fresh = TableCache(spark, 300), TableCache(spark, 0)
    assert held.read(path) is held.read(path)
    assert fresh.read(path) is not fresh.read(path)
    held.release(path)
    fresh.release(path)


def test_intermediate_tables_go_to_the_configured_folder(spark):
    assert shared_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
