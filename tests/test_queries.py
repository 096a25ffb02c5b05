"""Every registered query against its SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as driver

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = driver.queries(), driver.oracle_sql()
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no driver tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in os.listdir(FOLDER):
        connection.execute(f"create view {file.removesuffix('.parquet')} as select * from '{FOLDER}/{file}'")
    return connection


def comparable(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return (type(value).__name__, value)


def table(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(comparable(row[i]) for i in order) for row in data), key=repr)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    got = df.collect()
    if name not in ORACLES:
        assert got
        return
    result = duck.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert table(df.columns, got) == table(columns, result.fetchall())


def test_entry(spark):
    assert driver.entry(spark).count() > 0


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)
