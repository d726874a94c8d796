from __future__ import annotations

import itertools
import math

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from loanloom.operators import explain, tree_shap
from loanloom.operators.calibration import apply_isotonic, fit_isotonic
from loanloom.operators.features import CATEGORICAL_FEATURES, NUMERIC_FEATURES
from loanloom.operators.model import (
    FEATURES,
    RiskModel,
    class_weights,
    feature_names,
    fit_preprocessor,
    model_input,
    raw_score,
    score,
    train_model,
)
from loanloom.operators.split import stratified_split
from loanloom.operators.whatif import score_hypotheticals
from loanloom.sources import sample_book

def _rows(spark, n=3000):
    numeric = {c: F.expr(f"cast((loan_id * {7 + 2 * i}) % {31 + i} as double)") for i, c in enumerate(NUMERIC_FEATURES)}
    df = spark.range(n).select(F.col("id").alias("loan_id")).withColumns(numeric)
    df = df.withColumns(
        {
            "grade": F.expr("substr('ABC', cast(1 + loan_id % 3 as int), 1)"),
            "home_ownership": F.expr("case when loan_id % 2 = 0 then 'RENT' else 'OWN' end"),
            "purpose": F.expr("case when loan_id % 5 = 0 then 'car' else 'house' end"),
            # Only these two inputs matter.
            "default_flag": F.expr("cast((loan_id * 7919) % 100 < 10 + 15 * (loan_id % 3) + interest_rate as int)"),
        }
    )
    return df.withColumn("loan_amount", F.col("loan_amount") * 100 + 500)


@pytest.fixture(scope="module")
def fitted(spark):
    rows = stratified_split(_rows(spark), "default_flag", "loan_id").persist()
    parts = {s: rows.filter(F.col("split") == s) for s in ("train", "calibration", "test")}
    return train_model(parts["train"], parts["calibration"], rounds=5, depth=3), parts


def test_encoding_width_and_unknown_categories(fitted, spark):
    model, parts = fitted
    assert len(model.names) == 3 + 2 + 2 + len(NUMERIC_FEATURES)
    known = parts["test"].limit(1)
    odd = known.withColumns({c: F.lit("never seen") for c in CATEGORICAL_FEATURES})
    missing = known.withColumns({c: F.lit(None).cast("string") for c in CATEGORICAL_FEATURES})
    hot = [np.array(model.prepare(d).select(vector_to_array(FEATURES)).first()[0][:7]) for d in (known, odd, missing)]
    assert hot[0].sum() == 3 and not hot[1].any() and not hot[2].any()


def test_baseline_is_at_its_optimum(fitted):
    model, parts = fitted
    rows = model.prepare(parts["train"]).select(vector_to_array(FEATURES).alias("x"), "default_flag").collect()
    x, y = np.array([r.x for r in rows]), np.array([r.default_flag for r in rows], dtype=float)
    w = class_weights(parts["train"]).first()
    weight = np.where(y == 1, w.balanced_positive, w.balanced_negative)
    beta = model.baseline.coefficients.toArray()
    p = 1 / (1 + np.exp(-(x @ beta + model.baseline.intercept)))
    gradient = 0.1 * (weight * (p - y)) @ x + beta
    assert np.abs(gradient).max() < 0.05 * np.abs(0.1 * (weight * y) @ x).max()
    assert abs((weight * (p - y)).sum()) < 1e-2 * weight.sum()


def test_calibration_is_monotone_and_keeps_the_base_rate(fitted):
    model, parts = fitted
    rows = score(model, parts["calibration"]).select("raw_probability", "probability_of_default", "default_flag").collect()
    ordered = sorted((r.raw_probability, r.probability_of_default) for r in rows)
    assert all(a[1] <= b[1] + 1e-12 for a, b in zip(ordered, ordered[1:]))
    mean = sum(r.probability_of_default for r in rows) / len(rows)
    assert mean == pytest.approx(sum(r.default_flag for r in rows) / len(rows), abs=0.01)


def test_isotonic_clamps_outside_the_fitted_range(spark):
    points = spark.createDataFrame([(0.2, 0), (0.4, 1), (0.4, 0), (0.6, 1)], "raw_probability double, default_flag int")
    model = fit_isotonic(points)
    probe = spark.createDataFrame([(0.0,), (0.3,), (0.4,), (0.9,)], "raw_probability double")
    got = [r.probability_of_default for r in apply_isotonic(model, probe).orderBy("raw_probability").collect()]
    assert got == pytest.approx([0.0, 0.25, 0.5, 1.0])


def test_contributions_add_up_and_unused_features_have_none(fitted, spark):
    model, parts = fitted
    rules = explain.leaf_rules(spark, model.trees)
    used = {int(f) for features, *_ in rules for f in features}
    out = explain.shap_values(model, score(model, parts["test"]), rules).select("shap", "shap_base", "raw_probability").collect()
    for r in out:
        assert sum(r.shap) + r.shap_base == pytest.approx(math.log(r.raw_probability / (1 - r.raw_probability)), abs=1e-6)
        assert all(v == 0 for i, v in enumerate(r.shap) if i not in used)


def test_contributions_equal_brute_force_shapley_values(fitted, spark):
    model, parts = fitted
    rows = explain._tree_nodes(spark, model.trees).collect()
    nodes = {(r.treeID, r.id): r for r in rows}

    def expectation(x, known, tree, node_id=0):
        node = nodes[(tree, node_id)]
        if node.left < 0:
            return node.value
        if node.feature in known:
            return expectation(x, known, tree, node.left if x[node.feature] <= node.threshold else node.right)
        children = [nodes[(tree, c)] for c in (node.left, node.right)]
        return sum(c.cover / node.cover * expectation(x, known, tree, c.id) for c in children)

    weights = model.trees.treeWeights
    used = sorted({r.feature for r in rows if r.feature >= 0})
    sample = model.prepare(parts["test"]).limit(3)
    for r in explain.shap_values(model, sample).select(vector_to_array(FEATURES).alias("x"), "shap").collect():
        for j in used[:3]:
            others, total = [f for f in used if f != j], 0.0
            for size in range(len(others) + 1):
                share = math.factorial(size) * math.factorial(len(others) - size) / math.factorial(len(used))
                for chosen in itertools.combinations(others, size):
                    for tree, weight in enumerate(weights):
                        with_j = expectation(r.x, {*chosen, j}, tree)
                        total += share * 2 * weight * (with_j - expectation(r.x, set(chosen), tree))
            assert r.shap[j] == pytest.approx(total, abs=1e-9)


def test_saved_models_score_the_same(fitted, spark, tmp_path):
    model, parts = fitted
    model.save(str(tmp_path / "bundle"))
    again = RiskModel.load(str(tmp_path / "bundle"))
    columns = ["loan_id", "probability_of_default"]
    a, b = ({tuple(r) for r in score(m, parts["test"]).select(*columns).collect()} for m in (model, again))
    assert a == b and again.names == model.names


def test_raw_scores_come_from_the_given_model(fitted):
    model, parts = fitted
    prepared = model.prepare(parts["test"])
    a = raw_score(model.trees, prepared).agg(F.avg("raw_probability")).first()[0]
    b = raw_score(model.baseline, prepared).agg(F.avg("raw_probability")).first()[0]
    assert a != b


def test_hypothetical_loans_are_scored_whole(fitted, spark):
    model, _ = fitted
    sf = "/root/testdata/sf0.001"
    hyp, loans = sample_book.hypotheticals(spark, sf), sample_book.loans(spark, sf)
    rows = score_hypotheticals(hyp, loans, model).collect()
    assert len(rows) == hyp.count()
    for r in rows:
        assert 0 <= r.probability_of_default <= 1 and 1 <= len(r.reasons) <= 3 and len(r.drivers) == 5
        assert r.drivers[0].percent_of_max in (0.0, 100.0)
        assert r.expected_loss == pytest.approx(r.probability_of_default * 0.45 * float(r.loan_amount))


def test_a_real_loan_entered_again_keeps_its_rank(spark):
    from loanloom.operators.whatif import benchmark_hypotheticals

    loans = sample_book.loans(spark, "/root/testdata/sf0.001")
    again = {
        r.loan_id: r.loan_amount_rank_in_grade
        for r in benchmark_hypotheticals(loans.select("loan_id", "grade", "interest_rate", "loan_amount"), loans).collect()
    }
    grades = {}
    for r in loans.select("loan_id", "grade", "loan_amount").collect():
        grades.setdefault(r.grade, []).append((r.loan_amount, r.loan_id))
    for members in grades.values():
        for amount, loan_id in members:
            assert again[loan_id] == 1 + sum(a > amount for a, _ in members)


def test_driver_text_without_a_rising_feature(spark):
    row = spark.createDataFrame([([-0.5, -0.1, 0.0],)], "v array<double>")
    pairs = explain.named_values(F.col("v"), ["num__dti", "cat__grade_A", "num__x_y"])
    got = row.select(
        explain.increasing_drivers(pairs).alias("up"), explain.driver_text(pairs, 2).alias("text"),
        explain.driver_breakdown(pairs, 2).alias("parts"),
    ).first()
    assert got.up == [explain.NO_DRIVER]
    assert got.text == "num__dti (-0.500); cat__grade_A (-0.100)"
    assert [(d.driver, d.direction, round(d.percent_of_max)) for d in got.parts] == [
        ("Debt-to-income ratio", "Decreases risk", 100), ("Credit grade", "Decreases risk", 20),
    ]


def test_registered_queries_boost_the_rounds_of_the_training_job(spark):
    import inspect

    from loanloom.plans import jobs, queries

    rounds = inspect.signature(jobs.train).parameters["rounds"].default
    assert rounds == 200 and queries._model(spark, "/root/testdata/sf0.001").trees.getNumTrees == rounds


def _with_null(rows, n, *columns):
    return rows.withColumns({c: F.when(F.col("loan_id") % n != 0, F.col(c)) for c in columns})


def test_one_missing_value_touches_its_own_row_only(spark):
    whole = _rows(spark, 400)
    gap = whole.withColumn("interest_rate", F.when(F.col("loan_id") != 7, F.col("interest_rate")))
    parts = [fit_preprocessor(model_input(d)).transform(model_input(d)) for d in (whole, gap)]
    a, b = ({r.loan_id: np.array(r.x) for r in p.select("loan_id", vector_to_array(FEATURES).alias("x")).collect()} for p in parts)
    names = feature_names(fit_preprocessor(model_input(gap)))
    at, flag = names.index("num__interest_rate"), names.index("num__interest_rate_missing")
    assert not any(np.isnan(x).any() for x in b.values()) and len(b[0]) == len(a[0]) + 1
    assert b[7][at] == 0 and b[7][flag] == 1 and sum(x[flag] for x in b.values()) == 1
    known = np.array([r[0] for r in gap.filter("loan_id <> 7").select("interest_rate").collect()], float)
    for i in (0, 8, 399):
        value = float(whole.filter(F.col("loan_id") == i).first().interest_rate)
        assert b[i][at] == pytest.approx((value - known.mean()) / known.std(ddof=1))
        others = [k for k in range(len(a[0])) if k != at]
        assert b[i][others] == pytest.approx(a[i][others])


def test_columns_without_known_values_or_without_spread(spark):
    rows = _rows(spark, 50).withColumn("dti", F.lit(None).cast("double")).withColumn("term_months", F.lit(36))
    rows = rows.withColumn("annual_income", F.when(F.col("loan_id") == 3, F.lit(float("nan"))).otherwise(F.col("annual_income")))
    fitted = fit_preprocessor(model_input(rows))
    names = feature_names(fitted)
    x = np.array([r[0] for r in fitted.transform(model_input(rows)).select(vector_to_array(FEATURES)).collect()])
    assert not np.isnan(x).any() and not x[:, names.index("num__term_months")].any()
    assert x[:, names.index("num__dti_missing")].all() and x[:, names.index("num__annual_income_missing")].sum() == 1


def test_models_fit_and_explain_rows_with_gaps(spark, tmp_path):
    rows = _with_null(stratified_split(_rows(spark, 1500), "default_flag", "loan_id"), 5, "interest_rate", "dti", "grade")
    parts = {s: rows.filter(F.col("split") == s) for s in ("train", "calibration", "test")}
    model = train_model(parts["train"], parts["calibration"], rounds=4, depth=3)
    assert "num__interest_rate_missing" in model.names and "num__loan_amount_missing" not in model.names
    model.save(str(tmp_path / "gaps"))
    model = RiskModel.load(str(tmp_path / "gaps"))
    later = _with_null(parts["test"], 3, "loan_amount", "annual_income")  # gaps that training has not seen
    for r in explain.shap_values(model, score(model, later)).select("shap", "shap_base", "raw_probability").collect():
        assert sum(r.shap) + r.shap_base == pytest.approx(math.log(r.raw_probability / (1 - r.raw_probability)), abs=1e-6)


def _random_tree(draw, depth, n_features):
    """Nodes of a random tree: (feature, threshold, left, right) or a value, with covers."""
    if depth == 0 or draw.random() < 0.1:
        return draw.random() - 0.5, draw.random() + 0.1
    left, right = _random_tree(draw, depth - 1, n_features), _random_tree(draw, depth - 1, n_features)
    return (draw.randrange(n_features), draw.choice((-1.0, 0.0, 1.0)), left, right), left[1] + right[1]


def _leaves_of(node, path=()):
    body, cover = node
    if not isinstance(body, tuple):
        known = {}
        for f, low, high, share in path:
            a, b, c = known.get(f, (-np.inf, np.inf, 1.0))
            known[f] = (max(a, low), min(b, high), c * share)
        sides = np.array(list(known.values()), float).reshape(-1, 3).T
        return [tree_shap.Leaf(np.array(list(known), int), *sides, body)]
    f, t, left, right = body
    return _leaves_of(left, (*path, (f, -np.inf, t, left[1] / cover))) + _leaves_of(right, (*path, (f, t, np.inf, right[1] / cover)))


def _expected(node, x, known):
    body, cover = node
    if not isinstance(body, tuple):
        return body
    f, t, left, right = body
    if f in known:
        return _expected(left if x[f] <= t else right, x, known)  # a missing value is below no threshold
    return (left[1] * _expected(left, x, known) + right[1] * _expected(right, x, known)) / cover


@pytest.mark.parametrize("depth,n_features", [(1, 2), (4, 6), (8, 7)])
def test_shares_of_random_trees_equal_brute_force(depth, n_features):
    import random

    draw = random.Random(depth)
    trees = [_random_tree(draw, depth, n_features) for _ in range(3)]
    paths = tree_shap.pack([leaf for t in trees for leaf in _leaves_of(t)])
    x = np.array([[draw.choice((-2.0, -1.0, 0.5, 1.0, 2.0, np.nan)) for _ in range(n_features)] for _ in range(12)])
    got = tree_shap.contributions(x, paths)
    every = range(n_features)
    for row, own in zip(x, got):
        worth = {c: sum(_expected(t, row, set(c)) for t in trees) for k in range(n_features + 1) for c in itertools.combinations(every, k)}
        for j in every:
            total = 0.0
            for c, v in worth.items():
                if j not in c:
                    share = math.factorial(len(c)) * math.factorial(n_features - len(c) - 1) / math.factorial(n_features)
                    total += share * (worth[tuple(sorted((*c, j)))] - v)
            assert own[j] == pytest.approx(total, abs=1e-9)
        assert own.sum() + worth[()] == pytest.approx(worth[tuple(every)], abs=1e-9)


def test_labels_of_names_follow_the_label_table(spark):
    names = ["num__dti", "num__dti_missing", "cat__grade_A", "num__loan_amount_rank_in_grade", "cat__purpose_car", "signal_3", "grade_default_rate"]
    rows = explain.label_features(spark.createDataFrame([(n,) for n in names], "feature string")).collect()
    assert {r.feature: r.label for r in rows} == {n: explain.plain_label(n) for n in names}


def test_breakdown_orders_the_contributions_once(spark):
    pairs = explain.named_values(F.col("v"), ["num__dti", "num__x_y"])
    df = spark.createDataFrame([([0.5, -1.0],), (None,)], "v array<double>")
    told = df.select(explain.driver_breakdown(pairs, 2).alias("parts"), explain.increasing_drivers(pairs).alias("up"))
    plan = told._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array_sort(") == 2
    known, unknown = told.collect()
    assert [(p.direction, p.percent_of_max) for p in known.parts] == [("Decreases risk", 100.0), ("Increases risk", 50.0)]
    assert known.up == ["Debt-to-income ratio"] and unknown.parts is None and unknown.up == [explain.NO_DRIVER]
