"""Every registered query against its SQL, on the smallest tables."""

import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import difference, register
from ledger_spark.workload.oracle import ORACLE
from ledger_spark.workload.queries import QUERIES

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    connection = duckdb.connect()
    register(connection, SF)
    return connection


def test_entry(spark):
    assert entry(spark).count() == 10


def test_every_ledger_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query(spark, connection, name):
    got = queries()[name](spark, SF).toPandas()
    want = connection.sql(oracle_sql()[name]).df()
    assert difference(got, want) is None
