"""Shares read off tables against the polynomial they come from."""

from __future__ import annotations

import random

import numpy as np
import pytest

from loanloom.operators import tree_shap
from test_model import _leaves_of, _random_tree


@pytest.mark.parametrize("depth,n_features", [(1, 2), (3, 5), (4, 6), (6, 9)])
def test_tables_give_the_shares_of_the_polynomial(depth, n_features):
    draw = random.Random(depth)
    found = [leaf for _ in range(9) for leaf in _leaves_of(_random_tree(draw, depth, n_features))]
    known = tree_shap.tables(found)
    x = np.array([[draw.choice((-2.0, -1.0, 0.0, 0.5, 1.0, 2.0, np.nan)) for _ in range(n_features)] for _ in range(700)])
    assert all(len(t.features) <= tree_shap.TABLE_BITS for t in known) and len(known) < len(found)
    assert tree_shap.looked_up(x, known) == pytest.approx(tree_shap.contributions(x, tree_shap.pack(found)), abs=1e-12)


def test_more_rows_than_one_look_up_takes(monkeypatch):
    draw = random.Random(5)
    found = [leaf for _ in range(3) for leaf in _leaves_of(_random_tree(draw, 4, 6))]
    x = np.array([[draw.random() * 4 - 2 for _ in range(6)] for _ in range(50)])
    whole = tree_shap.looked_up(x, tree_shap.tables(found))
    monkeypatch.setattr(tree_shap, "LOOKUP_ROWS", 7)
    assert (tree_shap.looked_up(x, tree_shap.tables(found)) == whole).all()


def test_no_tables_for_deep_trees_and_for_a_single_leaf_an_empty_one(monkeypatch):
    long = tree_shap.Leaf(np.arange(9), np.full(9, -np.inf), np.zeros(9), np.full(9, 0.5), 1.0)
    assert tree_shap.tables([long]) is None
    stump = tree_shap.Leaf(np.array([], int), *np.zeros((3, 0)), 0.3)
    assert not tree_shap.looked_up(np.ones((4, 3)), tree_shap.tables([stump])).any()
    found = _leaves_of(_random_tree(random.Random(1), 4, 6))
    monkeypatch.setattr(tree_shap, "TABLE_BYTES", 10)
    assert tree_shap.tables(found) is None
