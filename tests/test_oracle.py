"""Every registered query against its DuckDB oracle at sf0.01."""

import pytest

import __spark_entry__ as entry
from compare import connect, differences
from haulgrain.testbed.oracle import ORACLE
from haulgrain.testbed.queries import QUERIES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLE.keys()
    assert entry.queries().keys() >= QUERIES.keys() and entry.oracle_sql().keys() >= ORACLE.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    assert differences(df, con, entry.oracle_sql()[name]) == []


def test_entry(spark):
    assert entry.entry(spark).count() > 0
