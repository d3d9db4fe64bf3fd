"""Registered checks: one Spark query per operator key, with its SQL oracle.

Each key maps to a callable ``(spark, sf_dir) -> DataFrame`` that runs an
operator of this package over the whole given tables (or frames Spark derives
from them), and — where the result is expressible in SQL — to an equivalent
DuckDB query over the same tables. Keys without an oracle are checked on row
counts only by the driver and against brute force in ``tests/``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    """Register ``fn`` under ``key`` with an optional oracle SQL string."""
    def deco(fn: QueryFn) -> QueryFn:
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key!r}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every query module (registration happens at import)."""
    from strata.queries import core, domains, flagship, io  # noqa: F401


def queries() -> dict[str, QueryFn]:
    load_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    load_all()
    return dict(ORACLES)
