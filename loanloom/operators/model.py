"""Preprocessing, training, scoring and storage of the default model."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassificationModel,
    GBTClassifier,
    LogisticRegression,
    LogisticRegressionModel,
)
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanloom.operators import boosting
from loanloom.operators.calibration import apply_isotonic, fit_isotonic
from loanloom.operators.decision import risk_score
from loanloom.operators.features import CATEGORICAL_FEATURES, LABEL, NUMERIC_FEATURES

FEATURES = "features"

#: Rows that make a task of their own in the many short passes of the training.
TASK_ROWS = 25_000


def model_input(df: DataFrame) -> DataFrame:
    """Numeric inputs as doubles, NaN as NULL; no repayment snapshot means no known delinquency."""
    doubles = {c: F.nullif(F.col(c).cast("double"), F.lit(float("nan"))) for c in NUMERIC_FEATURES}
    doubles["had_delinquency"] = F.coalesce(doubles["had_delinquency"], F.lit(0.0))
    return df.withColumns(doubles)


_SCALED, _MISSING = "__scaled_", "__missing_"


def _scaled_sql(column: str, mean: float | None, deviation: float | None) -> str:
    """A value in standard deviations from the mean of the known ones; a missing one counts as the mean."""
    if not deviation:
        return f"0.0D AS {_SCALED}{column}"
    return f"coalesce((`{column}` - {mean!r}D) / {deviation!r}D, 0.0D) AS {_SCALED}{column}"


def fit_preprocessor(train: DataFrame) -> PipelineModel:
    """One-hot categories, in which an unknown category is all zeros, followed by standardised numerics.

    Moments leave NULLs out. A NULL counts as the mean, so it touches its own row only; a column that has NULLs in
    ``train`` gets one more entry that is 1 where the value is missing. Both rules are stored with the model.
    """

    def known(c: str) -> Column:
        return F.struct(
            F.avg(c).alias("mean"), F.stddev_samp(c).alias("deviation"), F.count_if(F.col(c).isNull()).alias("n_null")
        ).alias(c)

    moments = train.agg(*[known(c) for c in NUMERIC_FEATURES]).first()
    gaps = [c for c in NUMERIC_FEATURES if moments[c].n_null]
    parts = [_scaled_sql(c, moments[c].mean, moments[c].deviation) for c in NUMERIC_FEATURES]
    parts += [f"CAST(`{c}` IS NULL AS DOUBLE) AS {_MISSING}{c}" for c in gaps]
    indexed = [f"__{c}_index" for c in CATEGORICAL_FEATURES]
    hot = [f"__{c}_hot" for c in CATEGORICAL_FEATURES]
    numeric = [f"{_SCALED}{c}" for c in NUMERIC_FEATURES] + [f"{_MISSING}{c}" for c in gaps]
    return Pipeline(
        stages=[
            StringIndexer(
                inputCols=CATEGORICAL_FEATURES,
                outputCols=indexed,
                handleInvalid="keep",
                stringOrderType="alphabetAsc",
            ),
            OneHotEncoder(inputCols=indexed, outputCols=hot, dropLast=True),
            SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__"),
            VectorAssembler(inputCols=[*hot, *numeric], outputCol=FEATURES, handleInvalid="error"),
        ]
    ).fit(train)


def feature_names(preprocess: PipelineModel) -> list[str]:
    """Names of the vector's entries, in order: cat__<column>_<category>, num__<column>, num__<column>_missing."""
    labels = preprocess.stages[0].labelsArray
    names = [f"cat__{c}_{v}" for c, values in zip(CATEGORICAL_FEATURES, labels) for v in values]
    numeric = preprocess.stages[-1].getInputCols()[len(CATEGORICAL_FEATURES) :]
    for c in numeric:
        names.append(f"num__{c[len(_SCALED):]}" if c.startswith(_SCALED) else f"num__{c[len(_MISSING):]}_missing")
    return names


def class_weights(train: DataFrame, label: str = LABEL) -> DataFrame:
    """One row: class counts, neg/pos, and the balanced weight of each class."""
    n, pos = F.count_if(F.col(label).isNotNull()), F.count_if(F.col(label) == 1)
    neg = F.count_if(F.col(label) == 0)
    zero = F.lit(0)
    return train.agg(
        neg.alias("n_negative"),
        pos.alias("n_positive"),
        (neg / F.nullif(pos, zero)).alias("positive_weight"),
        (n / F.nullif(2 * neg, zero)).alias("balanced_negative"),
        (n / F.nullif(2 * pos, zero)).alias("balanced_positive"),
    )


def _weighted(df: DataFrame, positive: float, negative: float) -> DataFrame:
    return df.withColumn("__weight", F.when(F.col(LABEL) == 1, F.lit(positive)).otherwise(F.lit(negative)))


def fit_baseline(train: DataFrame, c: float = 0.1, max_iter: int = 1000) -> LogisticRegressionModel:
    """L2 logistic regression with balanced classes on preprocessed rows."""
    w = class_weights(train).first()
    total = w.n_negative * w.balanced_negative + w.n_positive * w.balanced_positive
    return LogisticRegression(
        featuresCol=FEATURES,
        labelCol=LABEL,
        weightCol="__weight",
        maxIter=max_iter,
        regParam=1.0 / (c * total),
        elasticNetParam=0.0,
        standardization=False,
    ).fit(_weighted(train, w.balanced_positive, w.balanced_negative).select(FEATURES, LABEL, "__weight"))


def fit_trees(
    train: DataFrame, rounds: int = 200, depth: int = 4, rate: float = 0.1, seed: int = 42
) -> GBTClassificationModel:
    """Boosted trees on preprocessed rows, defaults weighted by neg/pos.

    MLlib grows them where a task holds all rows, ``boosting`` by the same rules where many tasks share them.
    """
    w = class_weights(train).first()
    # Without its metadata a one-hot entry is split by a threshold like any number.
    vector = F.col(FEATURES).alias(FEATURES, metadata={})
    rows = _weighted(train, w.positive_weight, 1.0).select(vector, F.col(LABEL).cast("double"), "__weight")
    estimator = GBTClassifier(
        featuresCol=FEATURES,
        labelCol=LABEL,
        weightCol="__weight",
        maxIter=rounds,
        maxDepth=depth,
        stepSize=rate,
        seed=seed,
        maxMemoryInMB=512,
    )
    n = w.n_negative + w.n_positive
    if n <= TASK_ROWS or not w.n_negative or not w.n_positive:
        return estimator.fit(rows)
    total = w.n_negative + w.n_positive * w.positive_weight
    return boosting.fit(estimator, rows, n, total, w.positive_weight)


def positive_probability(probability: str = "probability") -> Column:
    return vector_to_array(F.col(probability))[1]


def raw_score(model, df: DataFrame) -> DataFrame:
    """Add ``raw_probability`` of a fitted classifier to preprocessed rows."""
    scored = model.transform(df).withColumn("raw_probability", positive_probability())
    return scored.drop("rawPrediction", "probability", "prediction")


@dataclass(frozen=True)
class RiskModel:
    """Preprocessing, baseline, boosted trees and the isotonic map, fitted on separate splits."""

    preprocess: PipelineModel
    baseline: LogisticRegressionModel
    trees: GBTClassificationModel
    calibrator: IsotonicRegressionModel

    @property
    def names(self) -> list[str]:
        return feature_names(self.preprocess)

    def prepare(self, df: DataFrame) -> DataFrame:
        """Add the feature vector."""
        prepared = self.preprocess.transform(model_input(df))
        return prepared.drop(*[c for c in prepared.columns if c.startswith("__")])

    def save(self, path: str) -> None:
        for name in ("preprocess", "baseline", "trees", "calibrator"):
            getattr(self, name).write().overwrite().save(f"{path}/{name}")

    @classmethod
    def load(cls, path: str) -> RiskModel:
        return cls(
            PipelineModel.load(f"{path}/preprocess"),
            LogisticRegressionModel.load(f"{path}/baseline"),
            GBTClassificationModel.load(f"{path}/trees"),
            IsotonicRegressionModel.load(f"{path}/calibrator"),
        )


def _spread(train: DataFrame) -> DataFrame:
    """The model's inputs and the label in equal parts, two for each core at most.

    Files with few row groups would leave most cores idle in every pass of the training.
    """
    rows = model_input(train).select(*NUMERIC_FEATURES, *CATEGORICAL_FEATURES, LABEL)
    parts = min(2 * train.sparkSession.sparkContext.defaultParallelism, -(-train.count() // TASK_ROWS))
    return rows.repartition(max(1, parts))


def train_model(train: DataFrame, calib: DataFrame, rounds: int = 200, depth: int = 4, rate: float = 0.1) -> RiskModel:
    """Fit everything on ``train`` but the isotonic map, which sees only ``calib``."""
    preprocess = fit_preprocessor(model_input(train))
    prepared = preprocess.transform(_spread(train)).select(FEATURES, LABEL).persist()
    baseline = fit_baseline(prepared)
    trees = fit_trees(prepared, rounds, depth, rate)
    prepared.unpersist()
    held_out = raw_score(trees, preprocess.transform(model_input(calib)))
    return RiskModel(preprocess, baseline, trees, fit_isotonic(held_out))


def _with_scores(model: RiskModel, prepared: DataFrame) -> DataFrame:
    scored = apply_isotonic(model.calibrator, raw_score(model.trees, prepared))
    return scored.withColumn("risk_score", risk_score(F.col("probability_of_default"))).withColumn(
        "exposure_at_default", F.col("loan_amount")
    )


def score(model: RiskModel, df: DataFrame) -> DataFrame:
    """Add raw and calibrated default probability, the two-digit score and the exposure."""
    return _with_scores(model, model.prepare(df))


def model_scores(model: RiskModel, df: DataFrame) -> DataFrame:
    """(model, label, probability) rows of the baseline, the raw trees and the calibrated trees.

    Rows are prepared once and pass through all models side by side.
    """
    baseline = raw_score(model.baseline, model.prepare(df)).withColumnRenamed("raw_probability", "__baseline")
    scored = _with_scores(model, baseline)
    columns = {"baseline": "__baseline", "trees raw": "raw_probability", "trees calibrated": "probability_of_default"}
    versions = F.array(
        *[F.struct(F.lit(name).alias("model"), F.col(c).alias("probability")) for name, c in columns.items()]
    )
    return scored.select(F.col(LABEL).alias("label"), F.inline(versions)).select("model", "label", "probability")
