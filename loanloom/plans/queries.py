"""Registered queries: every operator over the sample tables.

A query takes (spark, sf_dir). Results use only strings, bigints and doubles,
so they compare across engines.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable
from functools import wraps

from pyspark.errors import PySparkException
from pyspark.ml.stat import Summarizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanloom.functions.ordered import exact_quantiles, money_bucket
from loanloom.functions.shared import materialise, shared_folder
from loanloom.operators import decision, explain, features, metrics, portfolio, quality, split, stress, vintage, whatif
from loanloom.operators.calibration import calibration_curve
from loanloom.operators.model import (
    FEATURES,
    RiskModel,
    class_weights,
    fit_preprocessor,
    model_input,
    model_scores,
    score,
    train_model,
    feature_names,
)
from loanloom.plans.jobs import append_load
from loanloom.plans.sql_views import create_views
from loanloom.plans.views import VIEW_NAMES, register_views
from loanloom.schemas import (
    EXPECTED_LOSS_COLUMNS,
    MODEL_MONITORING,
    REPAYMENTS,
    STRESS_TEST_RESULTS,
    TABLES,
    add_columns,
    enforce_schema,
)
from loanloom.sources import key_index, layout, raw_loans, sample_book, sinks
from loanloom.sources.tables import TableCache, read_macro, read_table

# The sample tables start in 1995, so later years stand in for the crisis window.
SAMPLE_CRISIS_YEARS = (1997, 1998, 1999)
# Boosting rounds of the registered model queries, as specified and as the jobs default to.
QUERY_ROUNDS = 200
STAMP = datetime.date(2024, 1, 31)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, integers as bigints, dates as text."""

    def column(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DecimalType, T.FloatType)):
            return c.cast("double").alias(f.name)
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            return c.cast("long").alias(f.name)
        if isinstance(f.dataType, (T.DateType, T.TimestampType)):
            return c.cast("string").alias(f.name)
        return c

    return df.select(*[column(f) for f in df.schema.fields])


def query(fn: Query) -> Query:
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(fn(spark, sf_dir))

    QUERIES[fn.__name__] = run
    return run


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})


# -- shared inputs ----------------------------------------------------------------


def _base(spark, d):
    b = sample_book.book(spark, d)
    return features.loan_base_features(b.loans, b.customers, b.repayments)


def _stored_base(spark, d):
    """The base columns behind the model table, stored: splits and peer counts read them several times."""
    return materialise(_base(spark, d).select(*features.MODEL_BASE_COLUMNS))


def _model_table(spark, d):
    return features.final_model_features(_stored_base(spark, d))


def _scores(spark, d):
    """Formula scores with percentile tiers and expected loss."""
    return decision.expected_loss(decision.assign_tier(sample_book.formula_scores(spark, d)))


def _labelled(spark, d):
    """(label, probability, prediction) rows of the formula scores."""
    s = sample_book.formula_scores(spark, d)
    y = sample_book.loans(spark, d).select("loan_id", F.col("default_flag").alias("label"))
    p = F.col("probability_of_default").cast("double")
    return s.join(y, "loan_id").select(
        "loan_id", "label", p.alias("probability"), decision.class_decision(p, 0.25).alias("prediction")
    )


def _vintage(spark, d):
    b = sample_book.book(spark, d)
    return vintage.vintage_analysis(
        vintage.vintage_loan_base(b.loans, b.repayments), crisis_years=SAMPLE_CRISIS_YEARS
    )


def _yearly(spark, d):
    return portfolio.yearly_origination_quality(sample_book.loans(spark, d))


def _sensitivity(spark, d):
    return stress.fit_sensitivity(_yearly(spark, d), sample_book.macro(spark, d))


def _stress(spark, d):
    """Scenario losses and the sensitivity behind them. The yearly rows are used throughout, so they are kept."""
    yearly = materialise(_yearly(spark, d))
    fit = materialise(stress.fit_sensitivity(yearly, sample_book.macro(spark, d)))
    return stress.stress_el(sample_book.formula_scores(spark, d), sample_book.loans(spark, d), yearly, fit), fit


def _raw(spark, d):
    return raw_loans.filter_resolved(sample_book.raw_file_rows(spark, d))


def _monitoring(spark, d):
    """One monitoring row per origination year, as if a model had been trained each year."""
    return _yearly(spark, d).select(
        F.concat(F.lit("v"), F.col("origination_year").cast("string")).alias("model_version"),
        F.make_date("origination_year", F.lit(12), F.lit(31)).alias("trained_date"),
        F.col("default_rate").alias("accuracy"),
        F.col("n_loans").alias("n_loans"),
    )


# -- sources and sinks --------------------------------------------------------------


@query
def customers_table(spark, d):
    return sample_book.customers(spark, d).drop("age", "created_at")


@query
def loans_table(spark, d):
    return sample_book.loans(spark, d)


@query
def repayments_table(spark, d):
    return sample_book.repayments(spark, d)


@query
def raw_to_customers(spark, d):
    return raw_loans.normalize(_raw(spark, d))[0].drop("age", "created_at")


@query
def raw_to_loans(spark, d):
    return raw_loans.normalize(_raw(spark, d))[1]


@query
def raw_to_repayments(spark, d):
    return raw_loans.normalize(_raw(spark, d))[2]


@query
def raw_csv_load(spark, d):
    """Write the raw file, read it back, number its rows and summarise the loaded loans per grade."""
    folder = shared_folder(spark, "raw-load")
    sample_book.raw_file_rows(spark, d).select(*raw_loans.RAW_COLUMNS).write.option("header", True).csv(
        f"{folder}/loan.csv"
    )
    raw = raw_loans.filter_resolved(raw_loans.read_raw_loans(spark, f"{folder}/loan.csv"))
    loans = raw_loans.normalize(raw_loans.assign_ids(raw_loans.stage(raw, f"{folder}/staged")))[1]
    return loans.groupBy("grade").agg(
        F.count("*").alias("n_loans"),
        F.sum("default_flag").alias("n_defaults"),
        F.sum("loan_amount").alias("loan_amount"),
        F.min("interest_rate").alias("min_rate"),
        F.max("interest_rate").alias("max_rate"),
        F.count("issue_date").alias("n_dated"),
    )


@query
def surrogate_ids(spark, d):
    numbered = raw_loans.assign_ids(spark.read.parquet(f"{d}/orders.parquet").select("o_orderkey"), "row_id")
    return numbered.agg(
        F.count("*").alias("n_rows"),
        F.min("row_id").alias("first_id"),
        F.max("row_id").alias("last_id"),
        F.count_distinct("row_id").alias("n_ids"),
    )


@query
def append_and_replace(spark, d):
    """Row counts after appending twice, replacing once and emptying."""
    path = f"{shared_folder(spark, 'append')}/repayments"
    rows = sample_book.repayments(spark, d)
    sinks.append(rows, path)
    sinks.append(rows, path)
    appended = spark.read.parquet(path).count()
    sinks.overwrite(rows, path)
    replaced = spark.read.parquet(path).count()
    sinks.truncate(rows, path)
    return spark.read.parquet(path).agg(
        F.lit(appended).alias("n_appended"), F.lit(replaced).alias("n_replaced"), F.count("*").alias("n_emptied")
    )


@query
def merge_rows(spark, d):
    """Grade G loans re-rated and undated loans added, the rest kept."""
    loans = sample_book.loans(spark, d).select("loan_id", "grade", "issue_date", F.col("interest_rate").cast("double"))
    old = loans.filter("issue_date is not null").drop("issue_date")
    new = loans.filter("grade = 'G' or issue_date is null").select("loan_id", "grade", F.col("interest_rate") + 1)
    return sinks.merge_rows(old, new.toDF("loan_id", "grade", "interest_rate"), ["loan_id"])


@query
def score_write_back(spark, d):
    """Scores stored twice under v1 and once under v2: the rerun replaces, it does not add."""
    path = f"{shared_folder(spark, 'scores')}/risk_scores"
    scored = _scores(spark, d)
    sinks.write_scores(scored, path, "v1", STAMP)
    sinks.write_scores(scored, path, "v1", STAMP)
    sinks.write_scores(scored, path, "v2", STAMP)
    return (
        sinks.read_scores(spark, path)
        .groupBy("model_version", "prediction_date", "lgd_assumption")
        .agg(
            F.count("*").alias("n_scores"),
            F.sum("expected_loss").alias("expected_loss"),
            F.sum("exposure_at_default").alias("exposure"),
        )
    )


@query
def stress_rows_stored(spark, d):
    """Stress rows upserted twice by scenario."""
    path = f"{shared_folder(spark, 'stress')}/stress_test_results"
    rows = materialise(stress.stress_rows(*_stress(spark, d), STAMP))
    sinks.upsert(rows, path, ["scenario"])
    sinks.upsert(rows, path, ["scenario"])
    return sinks.read_keyed(spark, path, STRESS_TEST_RESULTS)


@query
def upsert_keys(spark, d):
    """Monitoring rows under versions that look like numbers, one of them stored again: keys stay text."""
    path = f"{shared_folder(spark, 'monitoring')}/model_monitoring"
    loans = sample_book.loans(spark, d)
    for version, notes in (("007", "first"), ("20240131", "only"), ("007", "again")):
        row = loans.agg(F.round(F.avg("default_flag"), 4).alias("accuracy")).select(
            F.lit(version).alias("model_version"), F.lit(STAMP).alias("trained_date"), "accuracy", F.lit(notes).alias("notes")
        )
        sinks.upsert(enforce_schema(row, MODEL_MONITORING), path, ["model_version"])
    read = sinks.read_keyed(spark, path, MODEL_MONITORING)
    return read.select(
        "model_version", "trained_date", "accuracy", "notes", F.length("model_version").alias("n_characters"),
        F.lit(",".join(read.columns)).alias("column_order"),
    )


@query
def added_columns(spark, d):
    """Scores as stored before the expected-loss columns existed, with those columns added."""
    old = sample_book.formula_scores(spark, d).select("loan_id", "risk_score")
    return add_columns(old, EXPECTED_LOSS_COLUMNS.fields)


@query
def column_defaults(spark, d):
    """Repayments without a delinquency mark get the default; the mark is kept for large payments."""
    rows = sample_book.repayments(spark, d)
    large, small = rows.filter("amount_paid >= 50000"), rows.filter("coalesce(amount_paid < 50000, true)")
    return enforce_schema(large, REPAYMENTS).unionByName(enforce_schema(small.drop("days_late"), REPAYMENTS))


@query
def failed_upsert_changes_nothing(spark, d):
    """Stress rows stored by scenario; a second job that dies at its last scenario leaves them, a third replaces one."""
    path = f"{shared_folder(spark, 'versions')}/stress_test_results"
    rows = materialise(stress.stress_rows(*_stress(spark, d), STAMP))
    sinks.upsert(rows, path, ["scenario"])
    last = rows.agg(F.max("scenario")).scalar()
    dies = F.when(F.col("scenario") == last, F.raise_error(F.lit("the job dies"))).otherwise(F.lit(0.0))
    try:
        sinks.upsert(rows.withColumn("portfolio_el", dies.cast(rows.schema["portfolio_el"].dataType)), path, ["scenario"])
    except PySparkException as e:
        if "the job dies" not in str(e):
            raise
    doubled = rows.filter("scenario = 'baseline'").withColumn("portfolio_el", (F.col("portfolio_el") * 2).cast(rows.schema["portfolio_el"].dataType))
    sinks.upsert(doubled, path, ["scenario"])
    return sinks.read_keyed(spark, path, STRESS_TEST_RESULTS)


@query
def indexed_repayment_lookup(spark, d):
    """Repayments found through the key index of a stored table, and the files that each look-up opens."""
    path = f"{shared_folder(spark, 'indexed')}/repayments"
    sinks.write_repayments(sample_book.repayments(spark, d), path)
    out = None
    for loan in (1234, 1, -5, 999_999_999_999):
        n_files = len(key_index.files_with(spark, path, loan))
        found = key_index.indexed_lookup(spark, path, "loan_id", loan, REPAYMENTS)
        row = found.agg(F.lit(loan).cast("long").alias("loan_id"), F.count("*").alias("n_rows"), F.sum("amount_paid").alias("amount_paid"), F.lit(n_files).alias("n_files"))
        out = row if out is None else out.unionByName(row)
    return out


@query
def appended_loads(spark, d):
    """Two raw files loaded one after the other, the second twice: ids, sums and violations as of one load."""
    folder = shared_folder(spark, "loads")
    raw = sample_book.raw_file_rows(spark, d)
    for name, part in (("first", "loan_id % 3 = 0"), ("second", "loan_id % 3 <> 0")):
        raw.filter(part).select(*raw_loans.RAW_COLUMNS).write.option("header", True).csv(f"{folder}/{name}.csv")
    for name in ("first", "second", "second"):
        append_load(spark, f"{folder}/{name}.csv", f"{folder}/w", name)
    customers, loans, repayments = (read_table(spark, f"{folder}/w/{n}", TABLES[n]) for n in ("customers", "loans", "repayments"))
    broken = quality.audit_keys(loans, customers, "customer_id", "loan_id").unionByName(quality.audit_keys(repayments, loans, "loan_id"))
    per_load = loans.groupBy("load").agg(F.min("loan_id").alias("first_id"), F.max("loan_id").alias("last_id"), F.count("*").alias("n_loans"), F.count_distinct("loan_id").alias("n_ids"), F.sum("loan_amount").alias("loan_amount"), F.sum("default_flag").alias("n_defaults"))
    return per_load.withColumn("n_violations", materialise(broken.agg(F.count("*").alias("n"))).scalar())


def _with_headers(lines, header):
    """``lines`` (``value``) with the header before the first line of every partition, so each file written of them has one."""
    alone = lines.sparkSession.range(1, numPartitions=1).select(F.lit(header).alias("value"), F.lit(True).alias("header"))
    rows = alone.unionByName(lines.withColumn("header", F.lit(False)))
    first = F.monotonically_increasing_id().bitwiseAND(F.lit(2**33 - 1)) == 0
    marked = rows.withColumn("first", first)
    value = F.when(F.col("first") & ~F.col("header"), F.array(F.lit(header), "value")).otherwise(F.array("value"))
    return marked.select(F.explode(value).alias("value"))


@query
def rejected_records(spark, d):
    """A raw file with broken records, read with its errors: records, rows and rejects by reason."""
    folder = shared_folder(spark, "rejects")
    raw = sample_book.raw_file_rows(spark, d)
    kind = F.expr("case when loan_id % 97 = 0 then 'short' when loan_id % 89 = 0 then 'quote' when loan_id % 83 = 0 then 'number' when loan_id % 79 = 0 then 'rate' else 'good' end")
    fields = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in raw_loans.RAW_COLUMNS}
    fields["annual_inc"] = F.when(F.col("kind").isin("number"), F.lit("fifty thousand")).otherwise(fields["annual_inc"])
    fields["int_rate"] = F.when(F.col("kind") == "rate", F.lit("twelve%")).otherwise(fields["int_rate"])
    fields["purpose"] = F.when(F.col("kind") == "quote", F.concat(F.lit('"'), fields["purpose"])).otherwise(fields["purpose"])
    whole = F.concat_ws(",", *fields.values())
    short = F.concat_ws(",", *list(fields.values())[:7])
    lines = raw.withColumn("kind", kind).select(F.when(F.col("kind") == "short", short).otherwise(whole).alias("value"))
    _with_headers(lines, ",".join(raw_loans.RAW_COLUMNS)).write.text(f"{folder}/loan.csv")
    good, rejects = raw_loans.read_checked_loans(spark, f"{folder}/loan.csv")
    counts = raw_loans.reject_counts(rejects)
    read = good.agg(F.lit("none").alias("reason"), F.count("*").alias("n_records"), F.sum(F.col("annual_inc").cast("decimal(12,2)")).alias("annual_inc"))
    return read.unionByName(counts, allowMissingColumns=True)


@query
def key_audit(spark, d):
    """Loans of customers without income count as orphans; line items repeat their order's key."""
    b = sample_book.book(spark, d)
    orphans = quality.audit_keys(b.loans, b.customers.filter("annual_income > 0"), "customer_id")
    items = spark.read.parquet(f"{d}/lineitem.parquet").select(F.col("l_orderkey").alias("loan_id"))
    return orphans.unionByName(quality.audit_keys(b.loans, items, "loan_id", child_id="customer_id"))


@query
def exported_tables(spark, d):
    """Tables written as CSV and Parquet, counted after reading back."""
    b = sample_book.book(spark, d)
    folder = shared_folder(spark, "export")
    tables = {"customers": b.customers, "loans": b.loans, "repayments": b.repayments}
    csv = sinks.export_tables(tables, f"{folder}/csv", "csv")
    parquet = sinks.export_tables(tables, f"{folder}/parquet")
    read = [(n, "csv", spark.read.option("header", True).csv(p)) for n, p in csv.items()]
    read += [(n, "parquet", spark.read.parquet(p)) for n, p in parquet.items()]
    counts = [
        df.agg(F.lit(n).alias("table"), F.lit(f).alias("format"), F.count("*").alias("n_rows")) for n, f, df in read
    ]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


@query
def cached_table_reads(spark, d):
    cache = TableCache(spark)
    reads = [cache.read(f"{d}/orders.parquet") for _ in range(2)]
    out = reads[0].groupBy("o_orderpriority").agg(F.count("*").alias("n_orders"), F.min("o_orderkey").alias("first_order"))
    return out.join(reads[1].groupBy("o_orderpriority").agg(F.max("o_orderkey").alias("last_order")), "o_orderpriority")


@query
def registered_views(spark, d):
    """Rows of every registered view, counted through SQL."""
    b = sample_book.book(spark, d)
    register_views(spark, b.loans, b.customers, b.repayments, SAMPLE_CRISIS_YEARS)
    parts = [f"select '{v}' as view_name, count(*) as n_rows from {v}" for v in VIEW_NAMES]
    return spark.sql(" union all ".join(parts))


def _views_after_append(spark, d):
    """Views over stored tables with half of the loans; the other half is appended once they have been read."""
    b, folder = sample_book.book(spark, d), shared_folder(spark, "views")
    tables = {n: f"{folder}/{n}" for n in ("loans", "customers", "repayments")}
    early = F.col("loan_id") % 2 == 0
    sinks.append(b.customers, tables["customers"])
    sinks.append(b.loans.filter(early), tables["loans"])
    sinks.append(b.repayments.filter(early), tables["repayments"])
    create_views(spark, tables, SAMPLE_CRISIS_YEARS)
    for view in VIEW_NAMES:
        spark.table(view).limit(1).collect()
    sinks.append(b.loans.filter(~early), tables["loans"])
    sinks.append(b.repayments.filter(~early), tables["repayments"])


@query
def peer_view_after_append(spark, d):
    _views_after_append(spark, d)
    return spark.sql("select * from loan_peer_benchmark_features")


@query
def model_view_after_append(spark, d):
    _views_after_append(spark, d)
    return spark.sql("select * from final_model_features")


@query
def vintage_view_after_append(spark, d):
    _views_after_append(spark, d)
    return spark.sql("select * from vintage_analysis")


# -- features -------------------------------------------------------------------


@query
def loan_base_features(spark, d):
    return _base(spark, d)


@query
def loan_peer_benchmark_features(spark, d):
    return features.loan_peer_benchmark_features(_base(spark, d))


@query
def final_model_features(spark, d):
    return _model_table(spark, d)


@query
def peer_benchmarks_fit_on_train(spark, d):
    """Every loan looked up in the counts of the train split."""
    base = split.hash_split(_base(spark, d), "loan_id", method="modular")
    fitted = features.PeerBenchmarks.fit(base.filter("split = 'train'"))
    return fitted.transform(base).select("loan_id", "split", *features.PEER_COLUMNS)


# -- cohorts ----------------------------------------------------------------------


@query
def vintage_loan_base(spark, d):
    b = sample_book.book(spark, d)
    return vintage.vintage_loan_base(b.loans, b.repayments)


@query
def vintage_analysis(spark, d):
    return _vintage(spark, d)


@query
def cohort_sizes(spark, d):
    """Loans per origination quarter, read off the first bucket of its curve."""
    return _vintage(spark, d).filter("mob_bucket = 0").select("origination_quarter", "cohort_size")


@query
def crisis_comparison(spark, d):
    return rounded(vintage.crisis_comparison(_vintage(spark, d)), 6, "crisis_rate", "other_rate", "relative_difference")


@query
def yearly_origination_quality(spark, d):
    return _yearly(spark, d)


@query
def origination_drift(spark, d):
    return vintage.origination_drift(_yearly(spark, d), baseline_year=1996)


@query
def monthly_default_trend(spark, d):
    return rounded(
        portfolio.monthly_default_trend(sample_book.loans(spark, d)),
        6,
        "monthly_default_rate",
        "rolling_3m_default_rate",
    )


# -- portfolio ----------------------------------------------------------------------


@query
def default_rate_by_purpose(spark, d):
    return portfolio.default_rate_by(sample_book.loans(spark, d), "purpose", min_count=500)


@query
def riskiest_regions(spark, d):
    b = sample_book.book(spark, d)
    return portfolio.default_rate_by_region(b.loans, b.customers, min_count=200, limit=5)


@query
def default_rate_by_grade(spark, d):
    return portfolio.default_rate_by(sample_book.loans(spark, d), "grade", digits=6)


@query
def purpose_default_rates(spark, d):
    return portfolio.default_rate_by(sample_book.loans(spark, d), "purpose", min_count=300, digits=6)


@query
def global_default_rate(spark, d):
    return rounded(portfolio.global_default_rate(sample_book.loans(spark, d)), 6, "rate")


@query
def rate_ranges_by_grade(spark, d):
    return portfolio.rate_ranges_by_grade(sample_book.loans(spark, d))


@query
def payments_full_year(spark, d):
    b = sample_book.book(spark, d)
    return portfolio.loans_with_payments(b.loans, b.repayments, "1997-01-01", "1997-12-31")


@query
def payments_seven_days(spark, d):
    b = sample_book.book(spark, d)
    return portfolio.loans_with_payments(b.loans, b.repayments, "1997-03-01", "1997-03-07")


@query
def repayment_lookup(spark, d):
    return portfolio.point_lookup(sample_book.repayments(spark, d), "loan_id", 1234)


@query
def overview_kpis(spark, d):
    return rounded(
        portfolio.overview_kpis(sample_book.loans(spark, d), _scores(spark, d)), 6, "default_rate", "avg_risk_score"
    )


@query
def high_risk_exposure(spark, d):
    return rounded(portfolio.high_risk_exposure(_scores(spark, d), sample_book.loans(spark, d)), 6, "default_rate")


@query
def expected_loss_by_tier(spark, d):
    return portfolio.expected_loss_by_tier(_scores(spark, d))


@query
def expected_loss_by_fixed_tier(spark, d):
    """Fixed cut-offs leave the upper tiers empty, which count as 0."""
    scored = decision.assign_tier(sample_book.formula_scores(spark, d), mode="fixed")
    return portfolio.expected_loss_by_tier(decision.expected_loss(scored))


@query
def default_rate_by_tier(spark, d):
    return rounded(
        portfolio.default_rate_by_tier(_scores(spark, d), sample_book.loans(spark, d)), 6, "default_rate"
    )


@query
def tier_counts(spark, d):
    scored = decision.assign_tier(sample_book.formula_scores(spark, d), mode="fixed")
    return portfolio.tier_counts(portfolio.with_tier(sample_book.loans(spark, d), scored))


@query
def score_histogram(spark, d):
    return rounded(portfolio.score_histogram(sample_book.formula_scores(spark, d)), 6, "bin_start", "bin_end")


@query
def scored_portfolio(spark, d):
    return portfolio.with_tier(sample_book.loans(spark, d), _scores(spark, d)).select(
        "loan_id", "grade", "purpose", "default_flag", "recommended_action"
    )


@query
def filtered_portfolio(spark, d):
    tiered = portfolio.with_tier(sample_book.loans(spark, d), _scores(spark, d))
    return portfolio.filter_portfolio(tiered, grade="F", tier="Reduce credit limit", defaulted=True).select(
        "loan_id", "grade", "purpose", "recommended_action"
    )


@query
def filter_counts(spark, d):
    tiered = portfolio.with_tier(sample_book.loans(spark, d), _scores(spark, d))
    return portfolio.filter_counts(tiered, grade="F", recommended_action="Reduce credit limit", default_flag=1)


@query
def clustered_portfolio_filters(spark, d):
    """The tiered portfolio stored along a curve: rows per filter value, and whether half the files can be skipped."""
    path = f"{shared_folder(spark, 'clustered')}/portfolio"
    tiered = portfolio.with_tier(sample_book.loans(spark, d), _scores(spark, d))
    columns = portfolio.FILTER_COLUMNS
    layout.write_clustered(tiered.select("loan_id", *columns, "default_flag"), path, columns, "loan_id", files=64)
    admitted = layout.files_admitted(spark.read.parquet(path), columns)
    return admitted.select("name", "value", "n_rows", (2 * F.col("n_files") <= F.col("all_files")).cast("long").alias("skips_half"))


@query
def scores_of_filtered_loans(spark, d):
    chosen = portfolio.filter_portfolio(sample_book.loans(spark, d), grade="C", purpose="1-URGENT")
    return portfolio.scores_for(sample_book.formula_scores(spark, d), chosen).select("loan_id", "risk_score")


@query
def scores_with_outcome(spark, d):
    return portfolio.scores_with_outcome(_scores(spark, d), sample_book.loans(spark, d)).select(
        "loan_id", "risk_score", "recommended_action", "expected_loss", "loan_amount", "default_flag"
    )


@query
def score_preview(spark, d):
    """The five riskiest loans, ties by id."""
    order = [F.desc("risk_score"), F.asc("loan_id")]
    return portfolio.preview(_scores(spark, d), ["loan_id", "risk_score", "recommended_action"], order)


@query
def stamped_scores(spark, d):
    """Scores stored without a date, and how many carry the current one."""
    path = f"{shared_folder(spark, 'stamped')}/risk_scores"
    today = F.current_date()
    sinks.write_scores(_scores(spark, d), path, "v1")
    near = F.col("prediction_date").between(F.date_sub(today, 1), today)  # a run may pass midnight
    return sinks.read_scores(spark, path).agg(F.count("*").alias("n_scores"), F.count_if(near).alias("n_stamped"))


@query
def distinct_purposes(spark, d):
    return portfolio.distinct_sorted(sample_book.loans(spark, d), "purpose")


@query
def latest_model(spark, d):
    return portfolio.latest_model(_monitoring(spark, d))


@query
def model_history(spark, d):
    return portfolio.model_history(_monitoring(spark, d))


# -- profiling and cleaning ------------------------------------------------------------


@query
def null_report(spark, d):
    return quality.null_report(_base(spark, d))


@query
def class_balance(spark, d):
    return quality.class_balance(sample_book.loans(spark, d))


@query
def numeric_summary(spark, d):
    summary = quality.numeric_summary(
        _base(spark, d),
        ["loan_amount", "interest_rate", "dti", "annual_income", "employment_length", "loan_to_income_ratio"],
    )
    return rounded(summary, 4, "mean", "std", "min", "max")


@query
def income_quantiles(spark, d):
    amounts = sample_book.loans(spark, d)
    row = exact_quantiles(amounts, "loan_amount", [0.01, 0.5, 0.99], money_bucket(F.col("loan_amount")))
    incomes = exact_quantiles(_base(spark, d), "annual_income", [0.99], money_bucket(F.col("annual_income"))).scalar()
    q = F.col("quantiles")
    return row.select(
        F.round(q[0], 4).alias("amount_p01"),
        F.round(q[1], 4).alias("amount_p50"),
        F.round(q[2], 4).alias("amount_p99"),
        F.round(incomes[0], 4).alias("income_p99"),
    )


@query
def winsorized_income(spark, d):
    capped = quality.winsorize(_base(spark, d), "annual_income")
    return rounded(capped.select("loan_id", "annual_income"), 4, "annual_income")


@query
def rare_purposes(spark, d):
    return quality.rare_categories(sample_book.loans(spark, d), "purpose", min_count=200)


@query
def grouped_purposes(spark, d):
    return quality.group_rare(sample_book.loans(spark, d), "purpose", min_count=200).select("loan_id", "purpose")


@query
def cleaned_features(spark, d):
    cleaned = quality.clean(_model_table(spark, d))[0]
    return rounded(
        cleaned.select("loan_id", "annual_income", "loan_to_income_ratio", "employment_length", "dti", "purpose"),
        4,
        "annual_income",
    )


@query
def cleaning_report(spark, d):
    return rounded(quality.clean(_model_table(spark, d))[1], 4, "income_cap")


@query
def out_of_range_rates(spark, d):
    ranges = portfolio.rate_ranges_by_grade(sample_book.loans(spark, d))
    return quality.flag_ood(sample_book.hypotheticals(spark, d), ranges).select(
        "hypothetical_id", "grade", "interest_rate", "min_rate", "max_rate", "out_of_distribution"
    )


# -- sampling and splits ----------------------------------------------------------------


@query
def seeded_sample(spark, d):
    """Exactly 5,000 loans, all of them when the book is smaller."""
    return split.sample_n(sample_book.loans(spark, d), 5000, "loan_id", method="modular").select(
        "loan_id", "default_flag"
    )


@query
def stratified_split(spark, d):
    return split.stratified_split(sample_book.loans(spark, d), "default_flag", "loan_id", method="modular").select(
        "loan_id", "default_flag", "split"
    )


@query
def stratified_split_exact(spark, d):
    """Rows per stratum and split."""
    loans = sample_book.loans(spark, d)
    rows = split.stratified_split(loans, "default_flag", "loan_id", method="modular")
    return rows.groupBy("default_flag", "split").agg(F.count("*").alias("n_loans"))


@query
def hash_split(spark, d):
    return split.hash_split(sample_book.loans(spark, d), "loan_id", method="modular").select(
        "loan_id", "default_flag", "split"
    )


# -- decisions and metrics ------------------------------------------------------------------


@query
def tier_cutoffs(spark, d):
    c = F.col("cutoffs")
    return decision.tier_cutoffs(sample_book.formula_scores(spark, d)).select(
        F.round(c[0], 4).alias("p50"), F.round(c[1], 4).alias("p80"), F.round(c[2], 4).alias("p95")
    )


@query
def percentile_tiers(spark, d):
    return _scores(spark, d).select("loan_id", "risk_score", "recommended_action")


@query
def fixed_tiers(spark, d):
    return decision.assign_tier(sample_book.formula_scores(spark, d), mode="fixed").select(
        "loan_id", "probability_of_default", "recommended_action"
    )


@query
def expected_loss(spark, d):
    return decision.expected_loss(sample_book.formula_scores(spark, d)).select("loan_id", "expected_loss")


@query
def class_decision(spark, d):
    return _labelled(spark, d).select("loan_id", "probability", "prediction")


@query
def confusion_matrix(spark, d):
    return metrics.confusion(_labelled(spark, d))


@query
def classification_report(spark, d):
    return rounded(metrics.classification_report(_labelled(spark, d)), 6, "precision", "recall", "f1")


@query
def roc_auc(spark, d):
    return rounded(metrics.roc_auc(_labelled(spark, d)), 9, "roc_auc")


@query
def threshold_metrics(spark, d):
    return metrics.threshold_metrics(_labelled(spark, d), t=0.25)


@query
def calibration_bins(spark, d):
    return rounded(calibration_curve(_labelled(spark, d)), 6, "mean_predicted", "fraction_positive")


@query
def model_comparison_fixed_scores(spark, d):
    """The formula score, its square root and a rate-based score compared as three models."""
    rows = _labelled(spark, d).join(sample_book.loans(spark, d).select("loan_id", "interest_rate"), "loan_id")
    models = F.array(
        F.struct(F.lit("formula").alias("model"), F.col("probability").alias("p")),
        F.struct(F.lit("root").alias("model"), F.sqrt("probability").alias("p")),
        F.struct(F.lit("rate").alias("model"), (F.col("interest_rate").cast("double") / 50).alias("p")),
    )
    long = rows.select("label", F.inline(models)).withColumnRenamed("p", "probability")
    return rounded(
        metrics.compare_models(long, t=0.45), 6, "accuracy", "precision_score", "recall_score", "roc_auc"
    )


@query
def monitoring_row(spark, d):
    return metrics.monitoring_row(_labelled(spark, d), "v1", STAMP, notes="formula scores")


@query
def class_weights_of_loans(spark, d):
    return rounded(
        class_weights(sample_book.loans(spark, d)), 6, "positive_weight", "balanced_negative", "balanced_positive"
    )


# -- stress ------------------------------------------------------------------------------


@query
def macro_from_csv(spark, d):
    """The monthly series written as a headed CSV and read back."""
    path = f"{shared_folder(spark, 'macro')}/unrate"
    series = sample_book.macro(spark, d).select("observation_date", F.col("value").alias("UNRATE"))
    series.write.option("header", True).csv(path)
    return rounded(read_macro(spark, path), 6, "value")


@query
def annual_unemployment(spark, d):
    return rounded(stress.annual_mean(sample_book.macro(spark, d)), 6, "unemployment_rate")


@query
def yearly_with_unemployment(spark, d):
    joined = stress.yearly_with_macro(_yearly(spark, d), sample_book.macro(spark, d))
    return rounded(joined, 6, "unemployment_rate", "default_rate_pp")


@query
def macro_sensitivity(spark, d):
    return rounded(
        _sensitivity(spark, d), 6,
        "slope", "trend_slope", "r_squared", "ci_lower", "ci_upper", "predictor_corr", "applied",
    )


@query
def portfolio_default_rate(spark, d):
    return rounded(stress.weighted_default_rate(_yearly(spark, d)), 6, "rate")


@query
def year_risk_scalars(spark, d):
    return rounded(stress.year_risk(_yearly(spark, d)), 6, "year_risk_scalar")


@query
def exposure_by_year_and_pd(spark, d):
    grouped = stress.exposure_by_year_and_pd(
        sample_book.formula_scores(spark, d), sample_book.loans(spark, d), _yearly(spark, d)
    )
    return rounded(grouped, 6, "year_risk_scalar")


@query
def stress_expected_loss(spark, d):
    return _stress(spark, d)[0]


@query
def stress_result_rows(spark, d):
    return stress.stress_rows(*_stress(spark, d), STAMP)


@query
def stress_increase_vs_baseline(spark, d):
    return stress.increase_vs_baseline(_stress(spark, d)[0])


# -- explanations on given contributions ---------------------------------------------------


_VECTOR_NAMES = [f"num__{c}" for c in features.NUMERIC_FEATURES] + ["cat__grade_A", "cat__purpose_car"]


def _contributions(spark, d):
    names = [_VECTOR_NAMES[i] if i < len(_VECTOR_NAMES) else f"signal_{i}" for i in range(64)]
    e = spark.read.parquet(f"{d}/embeddings.parquet")
    return e.select("vec_id", explain.named_values(F.col("embedding"), names).alias("pairs"), "embedding")


@query
def top_contributions(spark, d):
    """The three largest entries by magnitude of every vector."""
    top = F.posexplode(explain.top_by_magnitude(F.col("pairs"), 3)).alias("place", "entry")
    return _contributions(spark, d).select("vec_id", top).select(
        "vec_id", "place", F.col("entry.name").alias("name"), F.round("entry.value", 6).alias("value")
    )


@query
def global_importance(spark, d):
    return rounded(explain.global_importance(_contributions(spark, d), "embedding"), 6, "importance")


@query
def driver_text(spark, d):
    return _contributions(spark, d).select("vec_id", explain.driver_text(F.col("pairs")).alias("drivers"))


@query
def increasing_drivers(spark, d):
    return _contributions(spark, d).select(
        "vec_id", F.array_join(explain.increasing_drivers(F.col("pairs")), "; ").alias("drivers")
    )


@query
def driver_breakdown(spark, d):
    rows = _contributions(spark, d).select(
        "vec_id", F.posexplode(explain.driver_breakdown(F.col("pairs"))).alias("place", "entry")
    )
    return rows.select("vec_id", "place", "entry.*").withColumn("percent_of_max", F.round("percent_of_max", 4))


@query
def feature_labels(spark, d):
    """Labels of the encoded names that the book's categories and the numeric inputs give."""
    rows = _base(spark, d)
    names = F.array(
        *[F.lit(f"num__{c}") for c in features.NUMERIC_FEATURES],
        *[F.concat(F.lit(f"cat__{c}_"), F.col(c)) for c in features.CATEGORICAL_FEATURES],
        F.concat(F.lit("region_"), F.col("region")),
    )
    distinct = rows.select("grade", "home_ownership", "purpose", "region").distinct()
    return explain.label_features(distinct.select(F.explode(names).alias("feature")).distinct())


# -- hypothetical loans -------------------------------------------------------------------


@query
def hypothetical_benchmarks(spark, d):
    placed = whatif.benchmark_hypotheticals(sample_book.hypotheticals(spark, d), sample_book.loans(spark, d))
    return rounded(
        placed.select(
            "hypothetical_id", "interest_rate_percentile_in_grade", "grade_default_rate", "loan_amount_rank_in_grade"
        ),
        9,
        "interest_rate_percentile_in_grade",
        "grade_default_rate",
    )


@query
def hypothetical_features(spark, d):
    rows = whatif.hypothetical_features(sample_book.hypotheticals(spark, d), sample_book.loans(spark, d))
    return rounded(rows, 6, "interest_rate_percentile_in_grade", "grade_default_rate", "region_default_rate")


# -- the trained model -----------------------------------------------------------------------

_tables: dict[tuple[str, str], DataFrame] = {}
_trained: dict[tuple[str, str], RiskModel] = {}


def _split_table(spark, d):
    """The cleaned, split model table, made once per session: one pass over the rows that cleaning has stored.

    Neither peers nor cleaning ask for the split, so where the stratified table is made, its rows serve both.
    """
    key, stratified = (spark.sparkContext.applicationId, d), (spark.sparkContext.applicationId, f"stratified {d}")
    if key not in _tables:
        cleaned = _tables[stratified].drop("split") if stratified in _tables else quality.clean(_model_table(spark, d))[0]
        _tables[key] = split.hash_split(cleaned, "loan_id", method="modular")
    return _tables[key]


def _part(spark, d, name):
    return _split_table(spark, d).filter(F.col("split") == name)


def _stratified_table(spark, d):
    """The cleaned model table with the split that the training job makes: stratified, before anything else."""
    key = (spark.sparkContext.applicationId, f"stratified {d}")
    if key not in _tables:
        base = split.stratified_split(_stored_base(spark, d), "default_flag", "loan_id", method="modular")
        _tables[key] = quality.clean(features.final_model_features(base))[0]
    return _tables[key]


def _stratified_part(spark, d, name):
    return _stratified_table(spark, d).filter(F.col("split") == name)


def _model(spark, d) -> RiskModel:
    """The model of the registered queries, trained on the stratified table once per session."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _trained:
        parts = [_stratified_part(spark, d, name) for name in ("train", "calibration")]
        _trained[key] = train_model(*parts, rounds=QUERY_ROUNDS)
    return _trained[key]


@query
def stratified_model_table(spark, d):
    """Every row of the table that the model is trained, calibrated and tested on."""
    return _stratified_table(spark, d).select("loan_id", "default_flag", "split", "purpose", F.round("annual_income", 4).alias("annual_income"))


@query
def stratified_comparison_check(spark, d):
    """``model_comparison_check`` on the test rows of the stratified table, which the model has not seen."""
    rows = metrics.compare_models(model_scores(_model(spark, d), _stratified_part(spark, d, "test")))
    return rows.select(
        "model", F.expr("tn + fp + fn + tp").alias("n_loans"), (F.col("roc_auc") >= 0.5).cast("int").alias("beats_chance")
    )


@query
def encoded_feature_means(spark, d):
    """Mean of every encoded feature over the train split: category shares, and 0 for standardised numerics."""
    train = model_input(_part(spark, d, "train"))
    fitted = fit_preprocessor(train)
    names = F.array(*[F.lit(n) for n in feature_names(fitted)])
    means = fitted.transform(train).agg(Summarizer.mean(F.col(FEATURES)).alias("m"))
    rows = means.select(F.posexplode(vector_to_array("m")).alias("i", "mean"))
    # + 0.0 turns a rounded -0.0 into 0.0.
    return rows.select(F.element_at(names, F.col("i") + 1).alias("feature"), (F.round("mean", 6) + 0.0).alias("mean"))


@query
def shap_additivity(spark, d):
    """Loans, and those whose contributions and base value do not add up to the model's log-odds."""
    model = _model(spark, d)
    rows = explain.shap_values(model, score(model, _split_table(spark, d)))
    total = F.aggregate("shap", F.col("shap_base"), lambda a, v: a + v)
    odds = F.ln(F.col("raw_probability") / (1 - F.col("raw_probability")))
    return rows.agg(F.count("*").alias("n_loans"), F.count_if(F.abs(total - odds) > 1e-6).alias("n_violations"))


def _with_gaps(spark, d):
    """The cleaned rows with NULLs where the source book has none: rates, and what a loan alone in its grade lacks."""
    gaps = {
        "interest_rate": F.when(F.col("loan_id") % 13 != 0, F.col("interest_rate")),
        "grade_default_rate": F.when(F.col("loan_id") % 29 != 0, F.col("grade_default_rate")),
        "purpose": F.when(F.col("loan_id") % 31 != 0, F.col("purpose")),
    }
    return _split_table(spark, d).withColumns(gaps)


@query
def encoded_features_with_gaps(spark, d):
    """Mean and mean square of the encoded numerics over train rows that miss values, and of the entries that say so."""
    train = model_input(_with_gaps(spark, d).filter("split = 'train'"))
    fitted = fit_preprocessor(train)
    names = feature_names(fitted)
    encoded = fitted.transform(train).select(vector_to_array(FEATURES).alias("x"))
    numeric = [(i, n) for i, n in enumerate(names) if n.startswith("num__")]
    sums = encoded.agg(*[F.struct(F.avg(F.col("x")[i]).alias("mean"), F.avg(F.col("x")[i] ** 2).alias("mean_square")).alias(n) for i, n in numeric])
    rows = F.array(*[F.struct(F.lit(n).alias("feature"), F.col(n)["mean"].alias("mean"), F.col(n)["mean_square"].alias("mean_square")) for _, n in numeric])
    told = sums.select(F.inline(rows))
    return told.select("feature", *[(F.round(c, 6) + 0.0).alias(c) for c in ("mean", "mean_square")])


@query
def shap_additivity_with_gaps(spark, d):
    """The same as ``shap_additivity`` for rows that miss values, and how many of them do."""
    model = _model(spark, d)
    rows = explain.shap_values(model, score(model, _with_gaps(spark, d)))
    total = F.aggregate("shap", F.col("shap_base"), lambda a, v: a + v)
    odds = F.ln(F.col("raw_probability") / (1 - F.col("raw_probability")))
    wrong = ~F.coalesce(F.abs(total - odds) <= 1e-6, F.lit(False))
    return rows.agg(
        F.count("*").alias("n_loans"),
        F.count_if(F.col("interest_rate").isNull() | F.col("grade_default_rate").isNull()).alias("n_with_gaps"),
        F.count_if(wrong).alias("n_violations"),
    )


@query
def calibration_is_monotone(spark, d):
    """Calibration loans, and neighbouring raw scores whose calibrated probability falls."""
    model = _model(spark, d)
    rows = score(model, _part(spark, d, "calibration"))
    hist = rows.groupBy(F.round("raw_probability", 4).alias("raw")).agg(
        F.count("*").alias("n"), F.min("probability_of_default").alias("lo"), F.max("probability_of_default").alias("hi")
    )
    earlier = F.max("hi").over(Window.partitionBy(F.lit(0)).orderBy("raw").rowsBetween(Window.unboundedPreceding, -1))
    checked = hist.withColumn("earlier", earlier)
    return checked.agg(
        F.sum("n").alias("n_loans"), F.count_if(F.col("lo") < F.col("earlier") - 1e-12).alias("n_violations")
    )


@query
def saved_model_scores(spark, d):
    """Loans, and those a saved and reloaded model scores differently."""
    model = _model(spark, d)
    path = f"{shared_folder(spark, 'model')}/bundle"
    model.save(path)
    rows = _split_table(spark, d)
    before = score(model, rows).select("loan_id", F.col("probability_of_default").alias("before"))
    after = score(RiskModel.load(path), rows).select("loan_id", F.col("probability_of_default").alias("after"))
    return before.join(after, "loan_id").agg(
        F.count("*").alias("n_loans"), F.count_if(F.abs(F.col("before") - F.col("after")) > 1e-12).alias("n_violations")
    )


@query
def scored_loans(spark, d):
    """All cleaned loans scored, tiered and explained by the trained model."""
    return _scored(spark, d).select(
        "loan_id", "probability_of_default", "risk_score", "recommended_action", "expected_loss", "top_drivers"
    )


def _scored(spark, d):
    """Scores and drivers of all cleaned loans, stored before cut-offs and losses are read off them."""
    model = _model(spark, d)
    explained = explain.top_drivers(explain.shap_values(model, score(model, _split_table(spark, d))), model.names)
    return decision.expected_loss(decision.assign_tier(materialise(explained.drop("features", "shap"))))


@query
def scored_loans_check(spark, d):
    """Cleaned loans scored, and those whose loss or tier does not follow from the stored score."""
    rows = materialise(_scored(spark, d))
    cuts = decision.tier_cutoffs(rows).scalar()
    p, s = F.col("probability_of_default"), F.col("risk_score").cast("double")
    loss = F.round(p * 0.45 * F.col("loan_amount").cast("double"), 2)
    n_above = sum((s >= cuts[i]).cast("int") for i in range(3))
    placed = rows.groupBy("recommended_action").agg(F.min(n_above).alias("n_above"), F.max(n_above).alias("most"))
    mixed = placed.filter("n_above <> most").agg(F.count("*")).scalar()
    return rows.agg(
        F.count("*").alias("n_loans"),
        F.count_if(F.abs(F.col("expected_loss").cast("double") - loss) > 0.011).alias("n_wrong_losses"),
        mixed.alias("n_mixed_tiers"),
        F.count_if(F.col("top_drivers").isNull()).alias("n_unexplained"),
    )


@query
def trained_model_comparison(spark, d):
    """Baseline, raw trees and calibrated trees on the test split of the stratified table."""
    return metrics.compare_models(model_scores(_model(spark, d), _stratified_part(spark, d, "test")))


@query
def model_comparison_check(spark, d):
    """Per model the test loans of the hash split, to which its four counts add up, and whether it ranks better than
    chance. The model has trained on some of them; ``stratified_comparison_check`` has the held-out rows."""
    rows = metrics.compare_models(model_scores(_model(spark, d), _part(spark, d, "test")))
    return rows.select(
        "model", F.expr("tn + fp + fn + tp").alias("n_loans"), (F.col("roc_auc") >= 0.5).cast("int").alias("beats_chance")
    )


@query
def hypothetical_scores_check(spark, d):
    """Hypothetical loans, those outside their grade's rates, and those whose loss is not PD x LGD x amount."""
    rows = whatif.score_hypotheticals(
        sample_book.hypotheticals(spark, d), sample_book.loans(spark, d), _model(spark, d)
    )
    loss = F.col("probability_of_default") * 0.45 * F.col("loan_amount").cast("double")
    return rows.agg(
        F.count("*").alias("n_rows"),
        F.sum("out_of_distribution").alias("n_out_of_range"),
        F.count_if(F.abs(F.col("expected_loss") - loss) > 1e-6).alias("n_wrong_losses"),
        F.count_if(~F.col("probability_of_default").between(0, 1)).alias("n_wrong_scores"),
    )


def _explained_loans(spark, d):
    """The loans of grade G, one by one."""
    rows = _stratified_table(spark, d)
    return whatif.explain_loans(rows, _model(spark, d), rows.filter("grade = 'G'"))


@query
def explained_loans(spark, d):
    return _explained_loans(spark, d).select(
        "loan_id", "probability_of_default", "risk_score", "recommended_action", "expected_loss",
        F.array_join("reasons", "; ").alias("reasons"), F.element_at("drivers", 1)["driver"].alias("main_driver"),
        "predicted_default", "actual_default",
    )


@query
def explained_loans_check(spark, d):
    """Explained loans, defaults among them, and those whose parts contradict each other."""
    rows = _explained_loans(spark, d)
    pd = F.col("probability_of_default")
    wrong = (
        (F.abs(F.col("expected_loss") - pd * 0.45 * F.col("loan_amount").cast("double")) > 1e-6)
        | ~F.size("reasons").between(1, 3)
        | (F.size("drivers") != 5)
        | (F.col("predicted_default") != (pd > 0.5).cast("int"))
        | (F.col("agrees") != (F.col("predicted_default") == F.col("actual_default")))
    )
    return rows.agg(
        F.count("*").alias("n_loans"), F.sum("actual_default").alias("n_defaults"), F.count_if(F.coalesce(wrong, F.lit(True))).alias("n_violations")
    )


@query
def shap_importance(spark, d):
    model = _model(spark, d)
    return explain.global_importance(explain.shap_values(model, _split_table(spark, d)), names=model.names)


@query
def hypothetical_scores(spark, d):
    rows = whatif.score_hypotheticals(
        sample_book.hypotheticals(spark, d), sample_book.loans(spark, d), _model(spark, d)
    )
    return rows.select(
        "hypothetical_id", "probability_of_default", "risk_score", "recommended_action", "expected_loss",
        "out_of_distribution", F.array_join("reasons", "; ").alias("reasons"),
        F.element_at("drivers", 1)["driver"].alias("main_driver"),
    )
