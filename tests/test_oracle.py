"""Every registered query that has SQL gives the rows that DuckDB gives."""

import datetime as dt
import decimal
import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF
from stratiform.plans.registry import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 4) + 0.0
    if isinstance(v, decimal.Decimal):
        return round(float(v), 4)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v.isoformat() if isinstance(v, dt.date) else v


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted(repr([plain(r[k]) for k in order]) for r in data)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        if Path(f"{SF}/{t}.parquet").exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(name, spark, duck):
    got = QUERIES[name](spark, SF)
    want = duck.execute(ORACLES[name])
    names = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(names)
    assert rows(got.columns, got.collect()) == rows(names, want.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
