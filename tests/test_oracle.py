"""Every query against its SQL oracle."""

import pytest
from check_oracle import database, differences
from conftest import SF_DIR

from __spark_entry__ import entry, oracle_sql, queries
from covshare.plans.catalogue import spark_queries
from covshare.plans.oracle import oracle_queries

# The text queries have tests of their own.
QUERIES = spark_queries()
ORACLES = oracle_queries()


@pytest.fixture(scope="module")
def con():
    return database(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_oracle(spark, con, name):
    assert differences(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) == []


def test_entry(spark):
    result = entry(spark)
    assert result.columns == ["county_fips", "pct_with_access"]
    assert result.count() > 0
