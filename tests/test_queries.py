"""Every registered query against its SQL on the smallest data, and the contract of the entry."""

import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as registered
from workload.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in os.listdir(FOLDER):
        view = name.partition(".")[0]
        connection.execute(f"CREATE VIEW {view} AS SELECT * FROM '{FOLDER}/{name}'")
    return connection


def rows(columns, tuples):
    order = [columns.index(c) for c in sorted(columns)]
    return Counter(tuple(r[i] for i in order) for r in tuples)


@pytest.mark.parametrize("name", registered.oracle_sql())
def test_query_equals_its_sql(spark, database, name):
    result = registered.queries()[name](spark, FOLDER)
    answer = database.execute(registered.oracle_sql()[name])
    columns = [d[0] for d in answer.description]
    assert sorted(result.columns) == sorted(columns)
    found = rows(result.columns, [tuple(r) for r in result.collect()])
    expected = rows(columns, answer.fetchall())
    assert found == expected
    assert found


def test_every_query_of_the_layers_has_sql():
    assert registered.queries().keys() >= registered.oracle_sql().keys() >= QUERIES.keys()


def test_entry(spark):
    fact = registered.entry(spark)
    assert fact.columns[:3] == ["order_number", "product_key", "customer_key"]
    assert fact.count() > 0
