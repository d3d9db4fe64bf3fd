"""The SQL forms give the queries' rows, value by value."""

import duckdb
import pytest

from strata.llm import registry

TABLES = ("documents", "embeddings", "labels")


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


@pytest.mark.parametrize("key", sorted(registry.oracle_sql()))
def test_query_equals_its_sql(spark, sf_dir, duck, key):
    cursor = duck.execute(registry.oracle_sql()[key])
    names = [d[0] for d in cursor.description]
    got = registry.queries()[key](spark, sf_dir)
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(repr, map(tuple, got.select(*names).collect()))) == sorted(map(repr, cursor.fetchall()))
