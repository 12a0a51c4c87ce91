"""Each registered query against its SQL on DuckDB, row by row."""

import datetime
import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry_points
from siltstone.catalog.queries import QUERIES
from siltstone.catalog.sql import ORACLE

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    yield connection
    connection.close()


def plain(value):
    if isinstance(value, datetime.datetime):
        return ("time", value.isoformat())
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    cursor = duck.execute(ORACLE[name])
    expected_columns = [d[0] for d in cursor.description]
    expected_types = {d[0]: str(d[1]) for d in cursor.description}
    expected = cursor.fetchall()
    assert sorted(df.columns) == sorted(expected_columns)
    rows = df.collect()
    assert expected, "the expected result has no rows: the check would be empty"
    assert len(rows) == len(expected)
    assert bag(df.columns, rows) == bag(expected_columns, expected)
    kinds = {
        "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
        "date": "DATE", "boolean": "BOOLEAN",
    }
    assert {name: kinds[kind] for name, kind in df.dtypes} == expected_types


def test_entry_runs(spark):
    assert entry_points.entry(spark).count() > 0
