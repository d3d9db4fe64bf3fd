"""Every registered query runs on the smoke tables and, where given, equals its SQL oracle."""

import datetime as dt
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as entry_module
from strata.queries import oracle_sql, queries

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
KEYS = sorted(queries())


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NULL" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return str(v)


def _canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def test_entry(spark):
    df = entry_module.entry(spark)
    rows = df.collect()
    assert df.columns == ["o_orderstatus", "order_count", "revenue", "avg_order_value", "customers", "pct_of_total"]
    assert len(rows) == 3


def test_every_key_has_callable_and_most_have_oracles():
    qs, sql = queries(), oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 118
    assert not any(k.startswith("pipeline") for k in qs)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, sf_dir, duck, key):
    df = queries()[key](spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    sql = oracle_sql().get(key)
    if sql is None:
        assert len(rows) >= 1
        return
    cur = duck.execute(sql)
    got = _canon(df.columns, rows)
    want = _canon([d[0] for d in cur.description], cur.fetchall())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]
