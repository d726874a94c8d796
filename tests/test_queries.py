"""Every registered query against its SQL twin on the smallest sample tables."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import connect, difference, oracle_rows, spark_rows

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_sql(spark, oracle, name):
    got = spark_rows(queries()[name](spark, SF_DIR))
    sql = oracle_sql().get(name)
    if sql is None:
        assert got[1]
    else:
        assert difference(got, oracle_rows(oracle, sql)) is None


def test_every_sql_twin_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0
