"""The batch jobs: ingest, train, score and stress. Each reads tables and writes tables."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanloom.functions.shared import materialise
from loanloom.operators.decision import LGD, assign_tier, expected_loss
from loanloom.operators.explain import shap_values, top_drivers
from loanloom.operators.features import PeerBenchmarks, final_model_features, loan_base_features, with_peer_benchmarks
from loanloom.operators.metrics import compare_models, monitoring_row
from loanloom.operators.model import RiskModel, model_scores, score, train_model
from loanloom.operators.portfolio import FILTER_COLUMNS, with_tier, yearly_origination_quality
from loanloom.operators.quality import clean
from loanloom.operators.split import sample_n, stratified_split
from loanloom.operators.stress import fit_sensitivity, stress_el, stress_rows
from loanloom.schemas import CUSTOMERS, LOANS, REPAYMENTS, STRESS_TEST_RESULTS
from loanloom.sources.layout import write_clustered
from loanloom.sources.raw_loans import (
    assign_ids,
    filter_resolved,
    normalize,
    read_checked_loans,
    read_raw_loans,
    stage,
)
from loanloom.sources.sinks import overwrite, read_keyed, read_scores, upsert, write_loans, write_repayments, write_scores
from loanloom.sources.tables import SCENARIOS, Scenario, read_table
from loanloom.sources.versions import claim_ids


def ingest(spark: SparkSession, csv_path: str, warehouse: str, sample_size: int | None = None) -> None:
    """Raw file -> customers, loans, repayments below ``warehouse``; ``sample_size`` asks for a sample of loans."""
    resolved = stage(filter_resolved(read_raw_loans(spark, csv_path)), f"{warehouse}/staged_raw")
    numbered = assign_ids(resolved)
    if sample_size is not None:
        picked = sample_n(numbered, sample_size, "loan_id").drop("loan_id")
        numbered = assign_ids(stage(picked, f"{warehouse}/staged_sample"))
    customers, loans, repayments = normalize(numbered, dated=True)
    overwrite(customers, f"{warehouse}/customers")
    write_loans(loans, f"{warehouse}/loans")
    write_repayments(repayments, f"{warehouse}/repayments")


def append_load(spark: SparkSession, csv_path: str, warehouse: str, load: str) -> dict[str, int]:
    """Add a raw file to the tables below ``warehouse`` as the load named ``load``; returns counts of its records.

    Each load is a partition ``load=<name>`` of every table and of ``rejects``, and ids go on where earlier loads ended.
    A load that is run again, after a crash at any point, claims the same ids and replaces its own partitions. A
    warehouse is filled either by ``ingest`` or by loads.
    """
    rows, rejects = read_checked_loans(spark, csv_path)
    overwrite(rejects, f"{warehouse}/rejects/load={load}")
    staged = stage(rows, f"{warehouse}/staged_loads/load={load}/all")
    resolved = stage(filter_resolved(staged), f"{warehouse}/staged_loads/load={load}/resolved")
    counts = {"n_read": staged.count(), "n_rejected": spark.read.parquet(f"{warehouse}/rejects/load={load}").count()}
    counts |= {"n_records": counts["n_read"] + counts["n_rejected"], "n_loans": resolved.count()}
    after = claim_ids(spark, f"{warehouse}/loads", load, counts["n_loans"])
    customers, loans, repayments = normalize(assign_ids(resolved, after=after), dated=True)
    overwrite(customers, f"{warehouse}/customers/load={load}")
    write_loans(loans, f"{warehouse}/loans/load={load}")
    write_repayments(repayments, f"{warehouse}/repayments/load={load}")
    return counts | {"first_id": after + 1}


def _tables(spark: SparkSession, warehouse: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return (
        read_table(spark, f"{warehouse}/loans", LOANS),
        read_table(spark, f"{warehouse}/customers", CUSTOMERS),
        read_table(spark, f"{warehouse}/repayments", REPAYMENTS),
    )


def build_model_table(spark: SparkSession, warehouse: str, leak_safe: bool = True, seed: int = 42) -> DataFrame:
    """Cleaned, split model table, written to ``<warehouse>/model_table`` and read back.

    Loans are split once, stratified by outcome, before anything is fitted. ``leak_safe`` fits the peer benchmarks on the train split only; otherwise
    every loan feeds them, test loans included.
    """
    loans, customers, repayments = _tables(spark, warehouse)
    overwrite(loan_base_features(loans, customers, repayments), f"{warehouse}/base_features")
    base = stratified_split(spark.read.parquet(f"{warehouse}/base_features"), "default_flag", "loan_id", seed=seed)
    if leak_safe:
        with_peers = PeerBenchmarks.fit(base.filter("split = 'train'")).transform(base, fill_unseen=True)
    else:
        with_peers = with_peer_benchmarks(base)
    overwrite(final_model_features(with_peers), f"{warehouse}/peer_features")
    cleaned, report = clean(spark.read.parquet(f"{warehouse}/peer_features"))
    overwrite(cleaned, f"{warehouse}/model_table")
    overwrite(report, f"{warehouse}/cleaning_report")
    return spark.read.parquet(f"{warehouse}/model_table")


def train(spark: SparkSession, warehouse: str, rounds: int = 200, leak_safe: bool = True) -> DataFrame:
    """Fit and save the model; returns the comparison of the three models on the test split."""
    table = build_model_table(spark, warehouse, leak_safe)
    parts = {s: table.filter(F.col("split") == s) for s in ("train", "calibration", "test")}
    model = train_model(parts["train"], parts["calibration"], rounds)
    model.save(f"{warehouse}/model")
    return compare_models(model_scores(model, parts["test"]))


def score_and_explain(
    spark: SparkSession,
    warehouse: str,
    model_version: str = "v1",
    splits: Sequence[str] | None = None,
    run_date: datetime.date | None = None,
    notes: str = "",
) -> None:
    """Score the whole model table (or some splits), assign tiers, explain, store scores and the monitoring row.

    The model runs once: scores and drivers are stored in ``<warehouse>/scored_rows``, and cut-offs, losses, the
    score table and the monitoring metrics are read off that. The metrics are those of the test split.
    """
    model = RiskModel.load(f"{warehouse}/model")
    rows = spark.read.parquet(f"{warehouse}/model_table")
    if splits is not None:
        rows = rows.filter(F.col("split").isin(*splits))
    explained = top_drivers(shap_values(model, score(model, rows)), model.names)
    kept = ["loan_id", "split", "default_flag", "raw_probability", "probability_of_default", "risk_score"]
    overwrite(explained.select(*kept, "exposure_at_default", "top_drivers"), f"{warehouse}/scored_rows")
    scored = spark.read.parquet(f"{warehouse}/scored_rows")
    write_scores(expected_loss(assign_tier(scored)), f"{warehouse}/risk_scores", model_version, run_date)
    test = scored.filter("split = 'test'")
    row = monitoring_row(test, model_version, run_date, notes, p="probability_of_default", y="default_flag")
    upsert(row, f"{warehouse}/model_monitoring", ["model_version"])


def store_portfolio(spark: SparkSession, warehouse: str, model_version: str = "v1", files: int = 64) -> DataFrame:
    """Model table with the tiers of one model version, laid out for filters by grade, purpose and tier.

    Written to ``<warehouse>/portfolio`` and read back. Choose ``files`` so that one holds some 100 MB.
    """
    scores = read_scores(spark, f"{warehouse}/risk_scores").filter(F.col("model_version") == model_version)
    tiered = with_tier(spark.read.parquet(f"{warehouse}/model_table"), scores)
    write_clustered(tiered, f"{warehouse}/portfolio", FILTER_COLUMNS, "loan_id", files)
    return spark.read.parquet(f"{warehouse}/portfolio")


def stress(
    spark: SparkSession,
    warehouse: str,
    macro: DataFrame,
    model_version: str = "v1",
    scenarios: Sequence[Scenario] = tuple(SCENARIOS),
    run_date: datetime.date | None = None,
) -> DataFrame:
    """Stress the stored scores of one model version and upsert the result rows."""
    loans = read_table(spark, f"{warehouse}/loans", LOANS)
    scores = read_scores(spark, f"{warehouse}/risk_scores").filter(F.col("model_version") == model_version)
    yearly = materialise(yearly_origination_quality(loans))
    sensitivity = materialise(fit_sensitivity(yearly, macro))
    rows = stress_rows(stress_el(scores, loans, yearly, sensitivity, scenarios, LGD), sensitivity, run_date)
    upsert(rows, f"{warehouse}/stress_test_results", ["scenario"])
    return read_keyed(spark, f"{warehouse}/stress_test_results", STRESS_TEST_RESULTS)
