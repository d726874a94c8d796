from __future__ import annotations

import datetime
import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loanloom.functions import columns as c
from loanloom.functions.ordered import exact_quantiles, money_bucket, positions, totals_before
from loanloom.functions.student_t import t_quantile


def one(spark, column, **values):
    types = {str: "string", float: "double", int: "long", datetime.date: "date"}
    row = spark.createDataFrame(
        [tuple(values.values())], ", ".join(f"{k} {types[type(v)]}" for k, v in values.items())
    )
    return row.select(column.alias("v")).first().v


@pytest.mark.parametrize(
    "text, number", [("10+ years", 10.0), ("< 1 year", 1.0), ("n/a", None), (" 36 months", 36.0), ("", None)]
)
def test_first_number(spark, text, number):
    assert one(spark, c.first_number(F.col("t")), t=text) == number


@pytest.mark.parametrize("text, number", [("13.56%", 13.56), ("7.9", 7.9), (" 5% ", 5.0), ("x", None)])
def test_percent_number(spark, text, number):
    assert one(spark, c.percent_number(F.col("t")), t=text.strip()) == number


@pytest.mark.parametrize("text, date", [("Mar-2015", datetime.date(2015, 3, 1)), ("2015-03", None), ("", None)])
def test_month_year_date(spark, text, date):
    assert one(spark, c.month_year_date(F.col("t")), t=text) == date


@pytest.mark.parametrize(
    "start, end, months",
    [
        ((2020, 1, 31), (2020, 2, 29), 0),
        ((2020, 1, 15), (2020, 2, 15), 1),
        ((2020, 1, 20), (2020, 1, 10), 0),
        ((2020, 3, 20), (2020, 1, 10), -2),
        ((2015, 1, 1), (2020, 1, 1), 60),
    ],
)
def test_whole_months(spark, start, end, months):
    column = c.whole_months(F.col("a"), F.col("b"))
    assert one(spark, column, a=datetime.date(*start), b=datetime.date(*end)) == months


def test_clip_keeps_null(spark):
    rows = spark.createDataFrame([(None,), (-1.0,), (0.5,), (7.0,)], "v double")
    got = [r.v for r in rows.select(c.clip(F.col("v"), 0.0, 1.0).alias("v")).collect()]
    assert got == [None, 0.0, 0.5, 1.0]


def test_ratios(spark):
    assert one(spark, c.safe_ratio(F.col("a"), F.col("b")), a=1.0, b=0.0) is None
    assert one(spark, c.ratio_or_zero(F.col("a"), F.col("b")), a=1.0, b=0.0) == 0.0


def test_totals_before_matches_a_plain_loop_with_nulls_and_both_orders(spark):
    rng = random.Random(5)
    rows = {(rng.choice(["a", "b", None]), rng.choice([None, *range(0, 90000, 700)])) for _ in range(300)}
    data = [(k, v, rng.randint(1, 9)) for k, v in rows]
    hist = spark.createDataFrame(data, "k string, v long, n long")
    for descending in (False, True):
        for bucket in (None, money_bucket(F.col("v"))):
            out = totals_before(hist, ["k"], "v", ["n"], bucket, descending).collect()
            assert len(out) == len(data)
            for r in out:
                def rank(v):
                    return (v is not None, v or 0)

                earlier = [
                    n for k, v, n in data
                    if k == r.k and (rank(v) > rank(r.v) if descending else rank(v) < rank(r.v))
                ]
                assert r.n_before == sum(earlier)
                assert r.n_total == sum(n for k, _, n in data if k == r.k)


def test_positions_places_unseen_values(spark):
    hist = spark.createDataFrame([("a", 10, 2), ("a", 20, 3), ("b", 5, 1)], "k string, v long, n long")
    points = spark.createDataFrame([("a", 5), ("a", 10), ("a", 15), ("a", 99), ("c", 1)], "k string, v long")
    got = {(r.k, r.v): (r.n_below, r.n_equal, r.n_total) for r in positions(points, hist, ["k"], "v").collect()}
    assert got == {
        ("a", 5): (0, 0, 5), ("a", 10): (0, 2, 5), ("a", 15): (2, 0, 5), ("a", 99): (5, 0, 5), ("c", 1): (0, 0, 0),
    }


@settings(max_examples=8, deadline=None)
@given(
    values=st.lists(st.integers(0, 10**7).map(lambda i: i / 100), min_size=1, max_size=60),
    q=st.sampled_from([0.0, 0.25, 0.5, 0.99, 1.0]),
)
def test_exact_quantile_is_the_interpolated_order_statistic(spark, values, q):
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    got = exact_quantiles(df, "v", [q], money_bucket(F.col("v"))).first().quantiles[0]
    ordered, place = sorted(values), q * (len(values) - 1)
    lo, hi = ordered[math.floor(place)], ordered[math.ceil(place)]
    assert got == pytest.approx(lo + (hi - lo) * (place - math.floor(place)), abs=1e-9)


def test_exact_quantile_of_nothing_is_null(spark):
    assert exact_quantiles(spark.createDataFrame([], "v double"), "v", [0.5]).first().quantiles == [None]


@pytest.mark.parametrize("dof, expected", [(1, 12.7062047364), (2, 4.3026527297), (4, 2.7764451052), (9, 2.2621571628)])
def test_t_quantile_known_values(dof, expected):
    assert t_quantile(0.975, dof) == pytest.approx(expected, abs=1e-9)


@pytest.mark.parametrize("p, dof, expected", [(0.975, 500, 1.96472), (0.995, 120, 2.61742)])
def test_t_quantile_of_many_degrees(p, dof, expected):
    assert t_quantile(p, dof) == pytest.approx(expected, abs=1e-5)
