"""Every query next to its SQL, over the whole smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from checks.compare import compare, database, spark_rows, sql_rows

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def tables():
    return database(SF_DIR)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, tables, name):
    got = spark_rows(entry.queries()[name](spark, SF_DIR))
    if name in SQL:
        assert compare(got, sql_rows(tables, SQL[name])) is None
    else:
        assert got[1]


def test_every_sql_belongs_to_a_query():
    from checks.oracles import oracle_sql

    assert set(oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns == ["threat_action", "n", "anomalies"]
