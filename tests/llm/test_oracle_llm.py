"""Every query of the subpackage that SQL can express, against its SQL, on the whole tables."""

from __future__ import annotations

import pytest

from cloakframe.llm.queries import ORACLE, QUERIES
from oracle_compare import compare, duckdb_views

# These are tested against brute force instead.
ROWS_ONLY = {
    "op2_crf_language", "op4_token_files", "op5_reshard", "op6_simhash", "op7_warc", "op9_wrapper", "op10_packing", "op11_secret_crf",
}


@pytest.fixture(scope="module")
def con(data_dir):
    return duckdb_views(data_dir)


def test_every_query_has_sql_or_says_why():
    assert set(QUERIES) - set(ORACLE) == ROWS_ONLY and set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, data_dir, con, name):
    difference = compare(QUERIES[name](spark, data_dir), con, ORACLE[name])
    assert difference is None, difference
