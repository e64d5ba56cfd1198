"""Registered training-data queries against their SQL in DuckDB."""

import duckdb
import pytest

from cellscape.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_same_as_sql(spark, name):
    duck = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark"):
        duck.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = duck.sql(queries.oracle_sql()[name])
    got = queries.queries()[name](spark, SF)
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    plain = lambda v: float(f"{v:.9g}") if isinstance(v, float) else v
    rows = lambda found, at: sorted((tuple(plain(r[i]) for i in at) for r in found), key=str)
    assert rows(got.collect(), columns) == rows(want.fetchall(), [want.columns.index(c) for c in columns])
