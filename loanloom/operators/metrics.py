"""Classification metrics from counts: confusion, report, AUC, comparison of models."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanloom.functions.columns import ratio_or_zero, safe_ratio
from loanloom.functions.ordered import probability_bucket, totals_before
from loanloom.operators.decision import class_decision
from loanloom.schemas import MODEL_MONITORING, enforce_schema


def _cell(label: int, predicted: int, y: str, p: str) -> Column:
    return F.count_if((F.col(y) == label) & (F.col(p) == predicted))


def _cells(df: DataFrame, y: str, p: str, group: Sequence[str]) -> DataFrame:
    return df.groupBy(*group).agg(
        _cell(0, 0, y, p).alias("tn"), _cell(0, 1, y, p).alias("fp"),
        _cell(1, 0, y, p).alias("fn"), _cell(1, 1, y, p).alias("tp"),
    )


def confusion(df: DataFrame, y: str = "label", p: str = "prediction", group: Sequence[str] = ()) -> DataFrame:
    """All four (label, prediction) counts, zeros included."""
    cells = _cells(df, y, p, group)
    grid = [("tn", 0, 0), ("fp", 0, 1), ("fn", 1, 0), ("tp", 1, 1)]
    rows = F.array(
        *[F.struct(F.lit(a).alias("label"), F.lit(b).alias("prediction"), F.col(c).alias("n")) for c, a, b in grid]
    )
    return cells.select(*group, F.inline(rows))


def classification_report(
    df: DataFrame, y: str = "label", p: str = "prediction", group: Sequence[str] = ()
) -> DataFrame:
    """precision, recall, f1 and support for both classes, accuracy, macro and weighted averages."""
    c = {k: F.col(k) for k in ("tn", "fp", "fn", "tp")}
    sides = {"0": (c["tn"], c["fn"], c["fp"]), "1": (c["tp"], c["fp"], c["fn"])}

    def row(name: str, precision: Column, recall: Column, f1: Column, support: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class"),
            precision.alias("precision"),
            recall.alias("recall"),
            f1.alias("f1"),
            support.cast("long").alias("support"),
        )

    per_class = {}
    for name, (hit, wrongly_in, wrongly_out) in sides.items():
        per_class[name] = (
            ratio_or_zero(hit, hit + wrongly_in),
            ratio_or_zero(hit, hit + wrongly_out),
            ratio_or_zero(2 * hit, 2 * hit + wrongly_in + wrongly_out),
            hit + wrongly_out,
        )
    total = c["tn"] + c["fp"] + c["fn"] + c["tp"]
    accuracy = ratio_or_zero(c["tn"] + c["tp"], total)
    zero, one = per_class["0"], per_class["1"]
    macro = [(zero[i] + one[i]) / 2 for i in range(3)]
    weighted = [ratio_or_zero(zero[i] * zero[3] + one[i] * one[3], total) for i in range(3)]
    rows = F.array(
        *[row(name, *values) for name, values in per_class.items()],
        row("accuracy", accuracy, accuracy, accuracy, total),
        row("macro avg", *macro, total),
        row("weighted avg", *weighted, total),
    )
    return _cells(df, y, p, group).select(*group, F.inline(rows))


def _ranked_scores(df: DataFrame, p: str, y: str, keys: Sequence[str]) -> DataFrame:
    """Per distinct score its rows and positives, and those of all lower scores; unknown scores and labels go."""
    hist = (
        df.filter(F.col(p).isNotNull() & F.col(y).isin(0, 1))
        .groupBy(*keys, F.col(p).alias("__p"))
        .agg(F.count("*").alias("n"), F.count_if(F.col(y) == 1).alias("pos"))
    )
    # Negatives are n - pos: with both counts in both levels, the levels share one shuffle of ``hist``.
    return totals_before(hist, list(keys), "__p", ["n", "pos"], probability_bucket(F.col("__p")))


def _area() -> Column:
    """Sum over distinct scores of positives x (negatives below + tied negatives / 2), over the number of pairs."""
    neg, neg_below = F.col("n") - F.col("pos"), F.col("n_before") - F.col("pos_before")
    won = F.sum(F.col("pos").cast("double") * (neg_below + neg / 2))
    return safe_ratio(won, F.sum("pos").cast("double") * F.sum(neg).cast("double"))


def _rated_scores(df: DataFrame, p: str, y: str, t: float, keys: Sequence[str]) -> DataFrame:
    """Confusion counts at a threshold and the area under the curve, from one set of counts per score."""
    yes, neg = class_decision(F.col("__p"), t) == 1, F.col("n") - F.col("pos")

    def rows(condition: Column, count: Column) -> Column:
        return F.sum(F.when(condition, count).otherwise(0))

    return _ranked_scores(df, p, y, keys).groupBy(*keys).agg(
        F.coalesce(rows(~yes, neg), F.lit(0)).alias("tn"), F.coalesce(rows(yes, neg), F.lit(0)).alias("fp"),
        F.coalesce(rows(~yes, F.col("pos")), F.lit(0)).alias("fn"), F.coalesce(rows(yes, F.col("pos")), F.lit(0)).alias("tp"),
        _area().alias("roc_auc"),
    )


def roc_auc(df: DataFrame, p: str = "probability", y: str = "label", group: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve, ties counted half, without sorting rows. NULL when one class is absent."""
    return _ranked_scores(df, p, y, group).groupBy(*group).agg(_area().alias("roc_auc"))


def _shares() -> dict[str, Column]:
    """Accuracy, precision and recall from the four counts; 0 when undefined."""
    tn, fp, fn, tp = (F.col(k) for k in ("tn", "fp", "fn", "tp"))
    return {
        "accuracy": ratio_or_zero(tn + tp, tn + fp + fn + tp),
        "precision_score": ratio_or_zero(tp, tp + fp),
        "recall_score": ratio_or_zero(tp, tp + fn),
    }


def threshold_metrics(
    df: DataFrame, p: str = "probability", y: str = "label", t: float = 0.5, group: Sequence[str] = ()
) -> DataFrame:
    """accuracy, precision and recall at a probability threshold, to four digits; 0 when undefined."""
    decided = df.withColumn("__decision", class_decision(F.col(p), t))
    cells = _cells(decided, y, "__decision", group)
    return cells.select(*group, *[F.round(share, 4).alias(name) for name, share in _shares().items()])


def compare_models(long_df: DataFrame, p: str = "probability", y: str = "label", t: float = 0.5) -> DataFrame:
    """One row per model: confusion counts, threshold metrics and AUC of a (model, label, probability) table."""
    shares = [share.alias(name) for name, share in _shares().items()]
    return _rated_scores(long_df, p, y, t, ["model"]).select("model", "tn", "fp", "fn", "tp", *shares, "roc_auc")


def monitoring_row(
    df: DataFrame,
    model_version: str,
    trained_date: datetime.date | None = None,
    notes: str = "",
    p: str = "probability",
    y: str = "label",
) -> DataFrame:
    """One model_monitoring row for a scored set."""
    stamp = F.current_date() if trained_date is None else F.lit(trained_date)
    row = _rated_scores(df, p, y, 0.5, []).select(
        F.lit(model_version).alias("model_version"),
        stamp.alias("trained_date"),
        *[F.round(share, 4).alias(name) for name, share in _shares().items()],
        F.round("roc_auc", 4).alias("roc_auc"),
        F.lit(notes).alias("notes"),
    )
    return enforce_schema(row, MODEL_MONITORING)
