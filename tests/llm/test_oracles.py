"""The queries that SQL can express, against DuckDB."""

from __future__ import annotations

import duckdb
import pytest

from fundscope.llm import queries

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_equals_duckdb(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    found = con.sql(queries.oracle_sql()[name])
    got = queries.queries()[name](spark, SF)
    assert sorted(got.columns) == sorted(found.columns)
    columns = got.columns
    want = sorted(found.project(", ".join(columns)).fetchall())
    assert sorted(map(tuple, got.collect())) == want
