"""Every registered query against its DuckDB oracle on the sf0.001 tables
(the driver repeats this at sf0.01).  Set FUNDSCOPE_ORACLE_SF to another
folder to run it on more data."""

import datetime as dt
import decimal
import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from fundscope.plans import catalog

from .conftest import SF_SMALL

SF = os.environ.get("FUNDSCOPE_ORACLE_SF", SF_SMALL)
TABLES = ["region", "nation", "customer", "supplier", "orders", "lineitem", "events"]


def _norm(v):
    """Integers and decimals exactly, doubles to 12 digits."""
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else f"{v:.12g}"
    if isinstance(v, decimal.Decimal):
        return str(v.normalize())
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(catalog.oracle_sql()) == set(catalog.queries())


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_matches_oracle(spark, duck, name):
    df = catalog.queries()[name](spark, SF)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    res = duck.execute(catalog.oracle_sql()[name])
    o_cols = [d[0] for d in res.description]
    o_rows = res.fetchall()
    assert sorted(s_cols) == sorted(o_cols)
    assert len(s_rows) == len(o_rows)
    assert _rows(s_cols, s_rows) == _rows(o_cols, o_rows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert df.columns == ["do_id", "solicitor", "lead_dollars", "co_dollars", "goal_dollars",
                          "count_all_flag", "goal_achieved"]
