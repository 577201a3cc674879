"""Every registered query against its SQL, on the whole tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_points
from cloakframe.plans import oracle, registry
from cloakframe.plans.oracle import ROWS_ONLY
from oracle_compare import compare, duckdb_views

QUERIES = registry.QUERIES
ORACLE = oracle.oracle_sql()


@pytest.fixture(scope="module")
def con(data_dir):
    return duckdb_views(data_dir)


def test_every_query_has_sql_or_says_why():
    assert set(QUERIES) - set(ORACLE) == set(ROWS_ONLY)
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, data_dir, con, name):
    difference = compare(QUERIES[name](spark, data_dir), con, ORACLE[name])
    assert difference is None, difference


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_rows_only(spark, data_dir, name):
    assert QUERIES[name](spark, data_dir).count() == 1


def test_registered():
    assert QUERIES.keys() <= entry_points.queries().keys()
    assert set(ORACLE) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    rows = entry_points.entry(spark).collect()
    assert len(rows) == 100
    assert rows[0]["c_name"] == "***-**-0000"
