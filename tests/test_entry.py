"""The driver contract, and every SQL-checked query against its DuckDB oracle."""

import datetime as dt
import decimal
import math
import re

import duckdb
import pytest

import __spark_entry__ as E

from conftest import SF_SMALL

# the training-data queries have their own tests beside that subpackage
CORE_KEYS = sorted(k for k in E.queries() if not re.match(r"op\d+_|pipeline$", k))


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["user_session", "window_start", "window_end"]


def test_keys_cover_survey_inventory():
    q, s = E.queries(), E.oracle_sql()
    assert len(CORE_KEYS) >= 48
    assert set(s) <= set(q)
    assert set(CORE_KEYS) <= set(s)


def _norm(v):
    if v is None:
        return None
    if isinstance(v, (float, decimal.Decimal)):
        v = float(v)
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(repr(_norm(r[i])) for i in order) for r in rows))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute(f"create view events as select * from read_parquet('{SF_SMALL}/events.parquet')")
    return con


@pytest.mark.parametrize("key", CORE_KEYS)
def test_query_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF_SMALL)
    res = duck.execute(E.oracle_sql()[key])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(ocols, orows)
