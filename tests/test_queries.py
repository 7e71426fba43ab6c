"""Every registered core query with SQL against DuckDB on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from newsloom import queries as core
from tests.oracle import connect, differences

D = "/root/testdata/sf0.001"
SQL = core.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(D)


@pytest.mark.skipif(not os.path.isdir(D), reason="no test tables")
@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, con, name):
    assert differences(core.queries()[name](spark, D), con, SQL[name]) == ""


@pytest.mark.skipif(not os.path.isdir(D), reason="no test tables")
@pytest.mark.parametrize("name", sorted(set(core.queries()) - set(SQL)))
def test_runs(spark, name):
    assert core.queries()[name](spark, D).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
