"""Every registered query against its SQL in DuckDB, on the smallest driver tables."""

from __future__ import annotations

import math
import os

import pytest

import __spark_entry__ as driver

duckdb = pytest.importorskip("duckdb")
FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are absent")


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def comparable(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    return str(value) if hasattr(value, "isoformat") else value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(([comparable(r[i]) for i in order] for r in rows), key=repr)


@pytest.mark.parametrize("name", list(driver.queries()))
def test_query(spark, oracle, name):
    df = driver.queries()[name](spark, FOLDER)
    got = [tuple(r) for r in df.collect()]
    sql = driver.oracle_sql().get(name)
    assert got
    if sql:
        cursor = oracle.execute(sql)
        names = [c[0] for c in cursor.description]
        assert sorted(names) == sorted(df.columns)
        expected = rows_of(names, cursor.fetchall())
        actual = rows_of(df.columns, got)
        assert len(actual) == len(expected)
        assert actual == expected


def test_entry(spark):
    assert driver.entry(spark).count() > 0
