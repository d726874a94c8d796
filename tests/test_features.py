from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from loanloom.functions.lookup import PIECES, hot_keys, salted_lookup
from loanloom.functions.ordered import null_safe_join
from loanloom.functions.shared import materialise

from loanloom.operators.features import (
    PeerBenchmarks,
    final_model_features,
    loan_base_features,
    loan_peer_benchmark_features,
    with_peer_benchmarks,
)
from loanloom.operators.split import stratified_split

LOAN = "loan_id long, customer_id long, loan_amount decimal(12,2), interest_rate decimal(5,2), term_months int, " \
    "grade string, sub_grade string, purpose string, issue_date date, default_flag int"  # fmt: skip


def test_unknown_income_and_missing_repayment(spark):
    loans = spark.createDataFrame(
        [(i, i, 1000, 5, 36, "A", "A1", "car", None, 0) for i in range(4)],
        LOAN.replace("decimal(12,2)", "int").replace("decimal(5,2)", "int"),
    )
    customers = spark.createDataFrame(
        [(0, 3000.0, 1, "x", 1.0, "RENT"), (1, 0.0, 1, "x", 1.0, "RENT"), (2, None, 1, "x", 1.0, "RENT")],
        "customer_id long, annual_income double, employment_length int, region string, dti double, home_ownership string",
    )
    repayments = spark.createDataFrame([(0, 10.0, 1)], "loan_id long, amount_paid double, days_late int")
    rows = {r.loan_id: r for r in loan_base_features(loans, customers, repayments).collect()}
    assert set(rows) == {0, 1, 2}
    assert [rows[i].loan_to_income_ratio for i in range(3)] == [0.3333, None, None]
    assert [rows[i].had_delinquency for i in range(3)] == [1, None, None]


def _windowed(base):
    grade, region = Window.partitionBy("grade"), Window.partitionBy("region")
    return base.select(
        "loan_id",
        F.percent_rank().over(grade.orderBy("interest_rate")).alias("interest_rate_percentile_in_grade"),
        F.avg("default_flag").over(grade).alias("grade_default_rate"),
        F.avg("default_flag").over(region).alias("region_default_rate"),
        F.rank().over(grade.orderBy(F.col("loan_amount").desc())).alias("loan_amount_rank_in_grade"),
    )


def _skewed_base(spark):
    """A third of the loans share one grade, rate and amount; one grade has a single loan; some values are NULL."""
    return spark.range(3000).select(
        F.col("id").alias("loan_id"),
        F.expr("case when id % 3 = 0 then 'A' when id = 1 then 'Z' when id % 41 = 0 then null else 'B' end").alias("grade"),
        F.expr("case when id % 3 = 0 then 'north' when id % 53 = 0 then null else 'south' end").alias("region"),
        F.lit(None).cast("date").alias("issue_date"),
        F.expr(
            "cast(case when id % 3 = 0 then 5.5 when id % 17 = 0 then null else (id * 37) % 200 / 10 end as decimal(5,2))"
        ).alias("interest_rate"),
        F.expr(
            "cast(case when id % 3 = 0 then 10000 when id % 19 = 0 then null else (id * 7919) % 90000 end as decimal(12,2))"
        ).alias("loan_amount"),
        F.expr("cast(case when id % 23 = 0 then null else (id * 31) % 5 div 4 end as int)").alias("default_flag"),
    )


def test_counts_give_the_same_as_windows_on_skewed_rows(spark):
    base = _skewed_base(spark)
    want = {r.loan_id: tuple(r)[1:] for r in _windowed(base).collect()}
    got = {
        r.loan_id: (r[6], r[7], r[8], r[9]) for r in loan_peer_benchmark_features(base).collect()
    }
    assert got == want
    single = got[1]
    assert single[0] == 0.0 and single[3] == 1


def test_fitting_on_all_loans_gives_the_in_place_benchmarks(spark):
    base = _skewed_base(spark).filter("grade is not null and interest_rate is not null and loan_amount is not null")
    columns = ["loan_id", "interest_rate_percentile_in_grade", "grade_default_rate", "loan_amount_rank_in_grade"]
    in_place = {tuple(r) for r in with_peer_benchmarks(base).select(*columns).collect()}
    fitted = {tuple(r) for r in PeerBenchmarks.fit(base).transform(base).select(*columns).collect()}
    assert fitted == in_place


def test_benchmarks_of_other_loans_do_not_see_their_outcome(spark):
    base = stratified_split(_skewed_base(spark), "default_flag", "loan_id")
    train = base.filter("split = 'train'")
    flipped = base.withColumn("default_flag", F.when(F.col("split") == "train", F.col("default_flag")).otherwise(1))
    fitted = PeerBenchmarks.fit(train)
    columns = ["loan_id", "grade_default_rate", "region_default_rate"]
    a = {tuple(r) for r in fitted.transform(base).select(*columns).collect()}
    b = {tuple(r) for r in fitted.transform(flipped).select(*columns).collect()}
    assert a == b


def test_an_unknown_grade_has_no_benchmarks(spark):
    base = _skewed_base(spark)
    fitted = PeerBenchmarks.fit(base)
    row = fitted.transform(base.limit(1).withColumn("grade", F.lit("new"))).first()
    assert row.interest_rate_percentile_in_grade is None
    assert row.grade_default_rate is None
    assert row.loan_amount_rank_in_grade is None
    filled = fitted.transform(base.limit(1).withColumn("grade", F.lit("new")), fill_unseen=True).first()
    assert filled.interest_rate_percentile_in_grade == 0.0 and filled.loan_amount_rank_in_grade == 1
    assert filled.grade_default_rate == base.agg(F.avg("default_flag")).first()[0]


def test_model_table_keeps_one_row_per_loan(spark):
    base = _skewed_base(spark)
    extra = ["term_months", "dti", "annual_income", "employment_length", "home_ownership", "purpose"]
    wide = base.withColumns({c: F.lit(None).cast("string") for c in [*extra, "loan_to_income_ratio", "had_delinquency"]})
    assert final_model_features(wide).count() == base.count()


def test_benchmarks_join_by_broadcast_when_small_and_by_shuffle_when_not(spark, tmp_path):
    _skewed_base(spark).write.parquet(str(tmp_path / "base"))
    base = spark.read.parquet(str(tmp_path / "base"))

    def joins():
        plan = with_peer_benchmarks(base)._jdf.queryExecution().executedPlan().toString()
        return plan.count("BroadcastHashJoin"), plan.count("SortMergeJoin")

    assert joins() == (3, 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1b")
    try:
        assert joins() == (0, 3)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _lookup_case(spark, n=40_000):
    """Half of the loans have one amount, half of the rest none."""
    amount = F.when(F.col("loan_id") % 2 == 0, 5000.0).when(F.col("loan_id") % 8 > 4, 1000.0 + F.col("loan_id") % 3000)
    return spark.range(n).withColumnRenamed("id", "loan_id").select(
        "loan_id", F.lit("A").alias("grade"), amount.cast("decimal(12,2)").alias("loan_amount"), F.expr("concat('text ', loan_id)").alias("text")
    )


def test_hot_keys_are_dealt_out_without_adaptive_execution(spark):
    rows, keys = _lookup_case(spark), ["grade", "loan_amount"]
    counts = materialise(rows.groupBy(*keys).agg(F.count("*").alias("n")))
    small = materialise(counts.select(*keys, (F.col("n") * 2).alias("twice")))
    hot = hot_keys(counts, keys, F.lit(rows.count()))
    salts = {r[0]: r[1] for r in counts.select("loan_amount", hot).collect()}
    assert salts[5000] == PIECES * 4 and salts[None] == PIECES * 2 and {v for k, v in salts.items() if k not in (5000, None)} == {1}
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        joined = salted_lookup(rows, small, keys, hot_keys(counts, keys, F.lit(40_000)))
        assert joined.columns == [*rows.columns, "twice"]
        per_task = sorted(r["count"] for r in joined.groupBy(F.spark_partition_id().alias("task")).count().collect())
        assert len(per_task) == 16 and per_task[-1] <= 2 * per_task[len(per_task) // 2], per_task
        plain = null_safe_join(rows, small, keys, "left")
        uneven = sorted(r["count"] for r in plain.groupBy(F.spark_partition_id().alias("task")).count().collect())
        assert uneven[-1] > 20_000  # what the same join does without salts
        assert sorted(map(tuple, joined.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_lookup_of_no_rows_and_without_hot_keys(spark):
    rows, keys = _lookup_case(spark, 50).filter("loan_id % 2 = 1"), ["grade", "loan_amount"]
    counts = materialise(rows.groupBy(*keys).agg(F.count("*").alias("n")))
    hot = hot_keys(counts, keys, F.lit(10_000_000))
    assert hot is None
    assert salted_lookup(rows, counts, keys, hot).agg(F.sum("n")).first()[0] == 12 + 13 * 13
    assert salted_lookup(rows.limit(0), counts, keys, hot).count() == 0
