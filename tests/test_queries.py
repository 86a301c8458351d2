"""Every query with SQL gives the rows of its SQL; every other one gives rows."""

import pytest
from check_queries import connect, differences
from conftest import SMALL

from __spark_entry__ import entry, oracle_sql, queries

EXACT = sorted(oracle_sql())


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_sql_belongs_to_queries():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).columns == ["state", "counts"]
    assert entry(spark).count() > 1


@pytest.mark.parametrize("name", EXACT)
def test_query_matches_sql(spark, con, name):
    assert differences(spark, con, SMALL, name) is None
