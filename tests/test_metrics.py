from __future__ import annotations

import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from loanloom.operators.calibration import calibration_curve
from loanloom.operators.decision import TIER_ORDER, assign_tier, expected_loss
from loanloom.operators.metrics import classification_report, compare_models, confusion, roc_auc, threshold_metrics
from loanloom.operators.portfolio import expected_loss_by_tier, score_histogram, tier_counts


def _scored(spark, n=500, seed=3):
    rng = random.Random(seed)
    rows = [(int(rng.random() < 0.3), round(rng.random(), 2)) for _ in range(n)]
    return rows, spark.createDataFrame(rows, "label int, probability double")


def test_auc_equals_counted_pairs_and_the_evaluator(spark):
    rows, df = _scored(spark)
    pos, neg = [p for y, p in rows if y], [p for y, p in rows if not y]
    pairs = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    got = roc_auc(df).first().roc_auc
    assert got == pytest.approx(pairs, abs=1e-12)
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="probability", labelCol="label", numBins=0)
    assert got == pytest.approx(evaluator.evaluate(df.withColumn("label", F.col("label").cast("double"))), abs=1e-9)


def test_auc_with_a_single_score_or_class(spark):
    same = spark.createDataFrame([(0, 0.5), (1, 0.5), (1, 0.5)], "label int, probability double")
    assert roc_auc(same).first().roc_auc == 0.5
    assert roc_auc(same.filter("label = 1")).first().roc_auc is None


def test_metrics_without_positive_predictions_are_zero(spark):
    df = spark.createDataFrame([(0, 0.1), (1, 0.2)], "label int, probability double")
    assert tuple(threshold_metrics(df).first()) == (0.5, 0.0, 0.0)


def test_confusion_has_four_rows_and_the_report_adds_up(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (0, 0)], "label int, prediction int")
    assert {tuple(r) for r in confusion(df).collect()} == {(0, 0, 1), (0, 1, 0), (1, 0, 0), (1, 1, 2)}
    report = {r["class"]: r for r in classification_report(df).collect()}
    assert report["macro avg"].f1 == 1.0 and report["1"].support == 2 and report["accuracy"].support == 3


def test_models_are_compared_side_by_side(spark):
    _, df = _scored(spark)
    long = df.withColumn("model", F.lit("a")).unionByName(df.select("label", F.lit(0.7).alias("probability"), F.lit("b").alias("model")))
    got = {r.model: r for r in compare_models(long).collect()}
    assert got["b"].roc_auc == 0.5 and got["b"].recall_score == 1.0
    assert got["a"].roc_auc == pytest.approx(roc_auc(df).first().roc_auc)


def test_calibration_bins_are_closed_on_the_right(spark):
    df = spark.createDataFrame([(0, 0.0), (1, 0.1), (0, 0.11), (1, 1.0)], "label int, probability double")
    assert [(r.bin, r.n) for r in calibration_curve(df).collect()] == [(0, 2), (1, 1), (9, 1)]


def _tiered(spark):
    df = spark.range(1000).select(
        F.col("id").alias("loan_id"),
        (F.col("id") / 1000).alias("probability_of_default"),
        F.bround(F.col("id") / 10, 2).alias("risk_score"),
        F.lit(1000.0).alias("exposure_at_default"),
    )
    return expected_loss(assign_tier(df))


def test_percentile_tiers_have_the_promised_shares(spark):
    counts = {r.recommended_action: r.n_loans for r in tier_counts(_tiered(spark)).collect()}
    assert [counts[t] for t in TIER_ORDER] == [500, 300, 150, 50]


def test_tier_losses_add_up_and_empty_tiers_are_zero(spark):
    rows = expected_loss_by_tier(_tiered(spark)).collect()
    assert [r.recommended_action for r in rows] == TIER_ORDER
    assert sum(r.expected_loss for r in rows) == pytest.approx(rows[0].total_expected_loss)
    low = expected_loss_by_tier(_tiered(spark).filter("loan_id < 100")).collect()
    assert [r.expected_loss > 0 for r in low] == [True, False, False, False]
    assert [r.n_loans for r in tier_counts(_tiered(spark).filter("loan_id < 100")).collect()] == [100, None, None, None]


def test_unknown_tier_mode_is_rejected(spark):
    with pytest.raises(ValueError):
        assign_tier(_tiered(spark), mode="other")


def test_histogram_covers_every_score(spark):
    bins = score_histogram(_tiered(spark), bins=30).collect()
    assert len(bins) == 30 and sum(r.n_loans for r in bins) == 1000
    flat = score_histogram(_tiered(spark).filter("loan_id = 5")).collect()
    assert [(r.bin, r.n_loans) for r in flat] == [(0, 1)]
