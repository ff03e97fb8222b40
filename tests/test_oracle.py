"""Every registered query against its SQL twin in DuckDB."""

import decimal
import math

import duckdb
import pytest

import __spark_entry__
from conftest import FOLDER
from tidemark import oracle, registry

TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    return str(value) if isinstance(value, decimal.Decimal) else value


def by_column(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


def test_every_query_has_a_twin():
    assert set(registry.queries()) == set(oracle.oracle_sql())


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, duck, name):
    result = registry.queries()[name](spark, FOLDER)
    cursor = duck.execute(oracle.oracle_sql()[name])
    expected = by_column([c[0] for c in cursor.description], cursor.fetchall())
    assert by_column(result.columns, [tuple(r) for r in result.collect()]) == expected


def test_entry(spark):
    result = __spark_entry__.entry(spark)
    assert result.columns == ["category", "total_orders", "total_quantity", "total_revenue"]
    assert result.count() == 6
