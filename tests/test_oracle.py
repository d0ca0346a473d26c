"""Every registered query against its comparison SQL on the smallest test data."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
QUERIES = entry.queries()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in os.listdir(FOLDER):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{FOLDER}/{file}'")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "~"
    if isinstance(value, (int, float)):
        return repr(float(value))
    return str(value)[:10] if hasattr(value, "year") else str(value)


def rows_of(records, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in records)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, duck, name):
    result = QUERIES[name](spark, FOLDER)
    cursor = duck.execute(SQL[name])
    names = [c[0] for c in cursor.description]
    expected = rows_of(cursor.fetchall(), names)
    assert sorted(result.columns) == sorted(names)
    assert rows_of(result.collect(), result.columns) == expected


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
