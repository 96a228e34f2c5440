"""Every driver query on the smallest tables, against DuckDB where it has SQL."""

import os

import duckdb
import pytest

import __spark_entry__ as driver
from gridpulse.checks import ORACLES, QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{os.path.join(sf_dir, name)}.parquet'")
    return connection


def plain(value):
    if isinstance(value, list):
        return tuple(plain(v) for v in value)
    return float(value) if isinstance(value, float) else value


def in_order(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, duck, sf_dir, name):
    df = driver.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    found = in_order(tuple(plain(r[c]) for c in columns) for r in df.collect())
    result = duck.execute(ORACLES[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == columns
    expected = in_order(tuple(plain(r[names.index(c)]) for c in columns) for r in result.fetchall())
    assert found and found == expected


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLES) <= set(driver.oracle_sql())


def test_entry(spark):
    assert driver.entry(spark).count() > 0
