"""Every registered query against its SQL on the test tables."""

import pytest

import __spark_entry__ as entry
from checks import oracle, queries
from compare_engines import problem

DATA = "/root/testdata/sf0.001"
QUERIES, ORACLES = queries.queries(), oracle.oracle_sql()


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert entry.queries().keys() >= QUERIES.keys() and entry.oracle_sql().keys() >= ORACLES.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, name):
    assert problem(spark, DATA, QUERIES[name], ORACLES[name]) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and df.columns[0] == "table_name"
