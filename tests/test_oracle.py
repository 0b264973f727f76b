"""Every catalogue query with an oracle equals DuckDB on the same tables (sf0.001)."""

import pytest

from conftest import SF_SMALL
from compare import assert_same, duck

from seasonflow.plans import ORACLE, QUERIES


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_oracle_key_is_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    assert_same(QUERIES[name](spark, SF_SMALL), con, ORACLE[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only_queries_run(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert df.count() > 0
