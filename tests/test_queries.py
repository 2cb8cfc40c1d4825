"""Every registered query against DuckDB."""

import pytest
from checking import assert_same, duckdb_views

from millrace.queries import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duckdb_views(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_oracle(spark, con, name):
    assert_same(QUERIES[name](spark, SF_DIR), con, ORACLE[name])
