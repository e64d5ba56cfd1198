"""Every registered domain query against DuckDB on the same tables, and rows where SQL can't say it."""

import datetime
import decimal
import math

import duckdb
import pytest

from cellscape import queries

SF = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
Q, SQL = queries.queries(), queries.oracle_sql()


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return float(v)
    return str(v) if isinstance(v, (datetime.date, datetime.datetime)) else v


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, duck, name):
    got = Q[name](spark, SF)
    want = duck.sql(SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(got.columns)
    at = [want.columns.index(c) for c in columns]
    key = lambda r: [(x is None, str(x)) for x in r]
    a = sorted(([plain(r[c]) for c in columns] for r in got.collect()), key=key)
    b = sorted(([plain(r[i]) for i in at] for r in want.fetchall()), key=key)
    assert a == b


@pytest.mark.parametrize("name", sorted(set(Q) - set(SQL)))
def test_has_rows(spark, name):
    assert Q[name](spark, SF).count() > 0
