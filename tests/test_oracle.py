"""Every registered query over the deliveries returns what DuckDB returns on the same tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as driver
from checks.oracle import oracle_sql
from checks.queries import queries

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = queries(), oracle_sql()


@pytest.fixture(scope="module")
def engine():
    connection = duckdb.connect()
    for table in ("lineitem", "orders", "customer"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= driver.queries().keys() and ORACLES.keys() <= driver.oracle_sql().keys()


def _plain(value):
    return round(value, 6) if isinstance(value, float) else value


# The replay check builds everything twice; test_build covers it.
@pytest.mark.parametrize("name", [n for n in QUERIES if n != "replay_check"])
def test_query(spark, engine, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    ours = sorted((tuple(_plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    result = engine.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    theirs = sorted((tuple(_plain(r[i]) for i in places) for r in result.fetchall()), key=repr)
    assert ours == theirs


def test_entry(spark):
    rows = driver.entry(spark).collect()
    assert len(rows) == 12 and sum(r.silver_eligible_rows for r in rows) == 5_495
