"""Trees from shared counts are MLlib's trees."""

from __future__ import annotations

import re

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from loanloom.operators import boosting, model, tree_shap
from loanloom.operators.model import FEATURES, LABEL, fit_trees

WEIGHT = 3.7


def _train(spark, n, parts):
    """Numbers without ties, numbers of few values, 0/1 entries and a constant."""
    numbers = [F.rand(k) - 0.3 for k in range(4)] + [F.floor(F.rand(9) * 6).cast("double"), (F.rand(8) < 0.2).cast("double"), F.lit(2.0)]
    rows = spark.range(0, n, 1, parts).select("id", F.array(*numbers).alias("a"))
    risk = 0.1 + 0.3 * F.col("a")[1] + 0.1 * F.col("a")[0] * F.col("a")[4]
    rows = rows.withColumn("y", (F.rand(99) < risk).cast("double"))
    vector = array_to_vector("a").alias(FEATURES)
    return rows.select(vector, F.col("y").alias(LABEL), F.when(F.col("y") == 1, WEIGHT).otherwise(1.0).alias("w")).localCheckpoint()


def _both(rows, estimator):
    n, defaults = rows.count(), rows.filter(F.col(LABEL) == 1).count()
    return estimator.fit(rows), boosting.fit(estimator, rows, n, n - defaults + WEIGHT * defaults, WEIGHT)


def _shape(trees):
    return [re.sub("Predict.*", "", line) for line in trees.toDebugString.splitlines()[1:]]


def test_trees_are_those_of_mllib(spark, tmp_path):
    rows = _train(spark, 9000, 3)
    estimator = GBTClassifier(featuresCol=FEATURES, labelCol=LABEL, weightCol="w", maxIter=12, maxDepth=3, seed=42, checkpointInterval=5)
    theirs, ours = _both(rows, estimator)
    assert _shape(ours) == _shape(theirs) and ours.treeWeights == theirs.treeWeights
    p = [m.transform(rows).select(vector_to_array("probability")[1].alias("p")).collect() for m in (theirs, ours)]
    assert np.abs(np.array(p[0]) - np.array(p[1])).max() < 1e-12
    assert ours.featureImportances.toArray() == pytest.approx(theirs.featureImportances.toArray(), abs=1e-9)
    assert ours.getMaxIter() == 12 and ours.numFeatures == 7 and ours.getFeaturesCol() == FEATURES
    ours.save(str(tmp_path / "again"))
    assert _shape(GBTClassificationModel.load(str(tmp_path / "again"))) == _shape(ours)
    assert tree_shap.mean_value(tree_shap.leaves(spark, ours)) == pytest.approx(tree_shap.mean_value(tree_shap.leaves(spark, theirs)))


def test_large_training_sets_are_grown_by_counts(spark, monkeypatch):
    monkeypatch.setattr(model, "TASK_ROWS", 1000)
    called, fit = [], boosting.fit
    monkeypatch.setattr(boosting, "fit", lambda *a: called.append(1) or fit(*a))
    rows = _train(spark, 3000, 2)
    fit_trees(rows.limit(900), rounds=2, depth=2)
    assert not called
    assert len(fit_trees(rows, rounds=2, depth=2).trees) == 2 and called


def test_nodes_of_one_kind_stay_leaves_and_constants_make_no_split(spark):
    rows = spark.range(400).select(
        array_to_vector(F.array((F.col("id") % 2).cast("double"), F.lit(1.0))).alias(FEATURES), (F.col("id") % 2).cast("double").alias(LABEL), F.lit(1.0).alias("w")
    )
    estimator = GBTClassifier(featuresCol=FEATURES, labelCol=LABEL, weightCol="w", maxIter=3, maxDepth=4, seed=42)
    assert _shape(boosting.fit(estimator, rows, 400, 400.0, 1.0)) == _shape(estimator.fit(rows))
    constant = rows.withColumn(FEATURES, array_to_vector(F.array(F.lit(1.0))))
    assert [t.numNodes for t in boosting.fit(estimator, constant, 400, 400.0, 1.0).trees] == [1, 1, 1]


def test_labels_other_than_0_and_1_are_refused(spark):
    rows = _train(spark, 300, 1).withColumn(LABEL, F.when(F.rand(1) < 0.5, F.col(LABEL)))
    with pytest.raises(Exception, match="labels must be 0 or 1"):
        boosting.fit(GBTClassifier(featuresCol=FEATURES, labelCol=LABEL, maxIter=1), rows, 300, 300.0, 1.0)


def test_packed_codes_keep_every_bin():
    rng = np.random.default_rng(1)
    x = rng.random((500, 9))
    thresholds = [np.sort(rng.random(k)) for k in (31, 31, 1, 1, 0, 9, 5, 31, 2)]
    bins = boosting.pack_features(thresholds)
    assert max(bins.sizes) <= boosting.CODE_BINS and len(bins.groups) < 8
    codes = boosting.encode(x, bins)
    for f, t in enumerate(thresholds):
        if len(t):
            code, own = bins.place(f)
            assert (own[codes[code]] == np.searchsorted(t, x[:, f])).all()
