"""Isotonic calibration and the calibration curve."""

from __future__ import annotations

from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fit_isotonic(
    calib: DataFrame, score: str = "raw_probability", label: str = "default_flag", digits: int = 5
) -> IsotonicRegressionModel:
    """Monotone map from raw score to default rate, fitted on a held-out split.

    Scores are rounded and averaged per distinct value with their counts as
    weights, so the last, single-task pass of the fit sees at most 10^digits + 1
    points whatever the size of the split.
    """
    points = (
        calib.groupBy(F.round(F.col(score), digits).alias(score))
        .agg(F.avg(F.col(label).cast("double")).alias("__rate"), F.count("*").cast("double").alias("__weight"))
        .filter("__rate is not null")
    )
    return IsotonicRegression(
        featuresCol=score, labelCol="__rate", weightCol="__weight", predictionCol="probability_of_default"
    ).fit(points)


def apply_isotonic(model: IsotonicRegressionModel, df: DataFrame) -> DataFrame:
    """Add ``probability_of_default``; scores outside the fitted range take the end values."""
    return model.transform(df)


def calibration_curve(
    df: DataFrame, p: str = "probability", label: str = "label", bins: int = 10
) -> DataFrame:
    """Mean predicted probability and observed rate per right-closed uniform bin; empty bins are left out."""
    value = F.col(p).cast("double")
    bin_of = F.least(F.greatest(F.ceil(value * bins) - 1, F.lit(0)), F.lit(bins - 1)).cast("int")
    return (
        df.filter(F.col(p).isNotNull())
        .groupBy(bin_of.alias("bin"))
        .agg(
            F.count("*").alias("n"),
            F.avg(value).alias("mean_predicted"),
            F.avg(label).alias("fraction_positive"),
        )
        .orderBy("bin")
    )
