"""Every registered query equals its DuckDB twin on the sf0.001 tables."""

import pytest

from harness import compare, duck
from rankmill.plans.registry import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SF), con, ORACLE[name])
    assert ok, msg


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_without_oracle_runs(spark, name):
    assert QUERIES[name](spark, SF).count() >= 0
