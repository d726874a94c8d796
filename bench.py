"""Headline queries on a stored loan book; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
The sample tables are first mapped and stored as the library's own tables,
which is not timed. Every query runs once to warm up; the median of three
further runs, plan building included, is reported.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanloom.functions.shared import materialise
from loanloom.operators import decision, explain, features, metrics, portfolio, quality, split, stress, vintage, whatif
from loanloom.operators.calibration import calibration_curve
from loanloom.operators.model import model_scores, score, train_model
from loanloom.plans.queries import QUERY_ROUNDS
from loanloom.schemas import CUSTOMERS, LOANS, REPAYMENTS
from loanloom.sources import sample_book, sinks
from loanloom.sources.tables import read_table

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 3
ROUNDS = int(os.environ.get("BENCH_ROUNDS", str(QUERY_ROUNDS)))  # 200 in the jobs


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = session()
    home = tempfile.mkdtemp(prefix="loanloom-bench-")
    book = sample_book.book(spark, SF_DIR)
    sinks.overwrite(book.customers, f"{home}/customers")
    sinks.write_loans(book.loans, f"{home}/loans")
    issued = book.loans.select("loan_id", "issue_date")
    sinks.write_repayments(book.repayments.join(issued, "loan_id", "left"), f"{home}/repayments")
    sinks.write_repayments(book.repayments, f"{home}/repayments_undated")
    sinks.overwrite(sample_book.formula_scores(spark, SF_DIR), f"{home}/scores")
    macro = sample_book.macro(spark, SF_DIR)
    hypotheticals = sample_book.hypotheticals(spark, SF_DIR)

    def tables():
        return (
            read_table(spark, f"{home}/loans", LOANS),
            read_table(spark, f"{home}/customers", CUSTOMERS),
            read_table(spark, f"{home}/repayments", REPAYMENTS),
        )

    def scores():
        return spark.read.parquet(f"{home}/scores")

    def base():
        return features.loan_base_features(*tables())

    sinks.overwrite(features.final_model_features(base()), f"{home}/model_table")

    def model_table():
        return spark.read.parquet(f"{home}/model_table")

    def labelled():
        outcome = tables()[0].select("loan_id", F.col("default_flag").alias("label"))
        pd = F.col("probability_of_default").cast("double")
        return scores().join(outcome, "loan_id").select("label", pd.alias("probability"))

    def tiered():
        return decision.expected_loss(decision.assign_tier(scores()))

    def stressed():
        loans = tables()[0]
        yearly = materialise(portfolio.yearly_origination_quality(loans))
        fit = materialise(stress.fit_sensitivity(yearly, macro))
        return stress.stress_el(scores(), loans, yearly, fit)

    def payments(first: str, last: str):
        loans, _, repayments = tables()
        return portfolio.loans_with_payments(loans, repayments, first, last)

    def curves():
        loans, _, repayments = tables()
        return vintage.vintage_analysis(vintage.vintage_loan_base(loans, repayments))

    cleaned = split.stratified_split(quality.clean(model_table())[0], "default_flag", "loan_id")
    sinks.overwrite(cleaned, f"{home}/split")
    parts = {s: spark.read.parquet(f"{home}/split").filter(F.col("split") == s) for s in ("train", "calibration", "test")}
    started = time.perf_counter()
    model = train_model(parts["train"], parts["calibration"], rounds=ROUNDS)
    training = time.perf_counter() - started
    rules = explain.leaf_rules(spark, model.trees)

    queries = {
        "payments_seven_days": lambda: payments("1997-03-01", "1997-03-07"),
        "payments_seven_days_undated": lambda: portfolio.loans_with_payments(
            tables()[0], read_table(spark, f"{home}/repayments_undated", REPAYMENTS), "1997-03-01", "1997-03-07"
        ),
        "payments_full_year": lambda: payments("1997-01-01", "1997-12-31"),
        "repayment_lookup": lambda: portfolio.point_lookup(tables()[2], "loan_id", 12345),
        "monthly_default_trend": lambda: portfolio.monthly_default_trend(tables()[0]),
        "default_rate_by_purpose": lambda: portfolio.default_rate_by(tables()[0], "purpose", 500),
        "riskiest_regions": lambda: portfolio.default_rate_by_region(*tables()[:2]),
        "yearly_origination_quality": lambda: portfolio.yearly_origination_quality(tables()[0]),
        "loan_base_features": base,
        "loan_peer_benchmark_features": lambda: features.loan_peer_benchmark_features(base()),
        "final_model_features": lambda: features.final_model_features(base()),
        "vintage_analysis": curves,
        "cleaned_features": lambda: quality.clean(model_table())[0],
        "stratified_split": lambda: split.stratified_split(model_table(), "default_flag", "loan_id"),
        "hash_split": lambda: split.hash_split(model_table(), "loan_id"),
        "expected_loss_by_tier": lambda: portfolio.expected_loss_by_tier(tiered()),
        "roc_auc": lambda: metrics.roc_auc(labelled()),
        "calibration_bins": lambda: calibration_curve(labelled()),
        "stress_expected_loss": stressed,
        "hypothetical_benchmarks": lambda: whatif.benchmark_hypotheticals(hypotheticals, tables()[0]),
        "score_test_split": lambda: score(model, parts["test"]),
        "shap_test_split": lambda: explain.shap_values(model, parts["test"], rules),
        "trained_model_comparison": lambda: metrics.compare_models(model_scores(model, parts["test"])),
    }
    seconds = {}
    for name, build in queries.items():
        times = []
        for _ in range(1 + RUNS):
            started = time.perf_counter()
            run(build())
            times.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(times[1:]), 4)
    seconds[f"train_{ROUNDS}_rounds"] = round(training, 4)
    print(
        json.dumps(
            {
                "metric": "sum of median query times",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "loans": tables()[0].count(),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
