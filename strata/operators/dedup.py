"""Deduplication: top-1 per key, exact-duplicate removal, one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedup_top1(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
               tie_breakers: Sequence[Column] = ()) -> DataFrame:
    """Keep the first row per key under ``order`` (+ tie-breakers for a stable pick).

    Written as ``row_number() = 1`` so Catalyst plans a partial
    ``WindowGroupLimit`` before the shuffle: each map task keeps one row per
    key, so even a key holding a third of all rows ships one row per task.
    """
    w = Window.partitionBy(*keys).orderBy(*order, *tie_breakers)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def dedup_hash(df: DataFrame, hash_col: str = "_row_hash", whole_row: bool = False) -> DataFrame:
    """Remove exact duplicates identified by a row hash.

    Both forms aggregate with a map-side partial step, so a group of many
    copies collapses before the shuffle. ``whole_row=True`` states that the
    hash covers every other column of ``df`` (copies are equal rows): the
    dedup is then a keys-only hash aggregate over the row. Otherwise one
    arbitrary row per hash is kept, which carries the other columns through
    ``first`` and plans a sort-based aggregate.
    """
    if whole_row:
        return df.dropDuplicates()
    return df.dropDuplicates([hash_col])


def dedup_key(df: DataFrame, key: str | Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, chosen by a stated order rather than arbitrarily."""
    keys = [key] if isinstance(key, str) else list(key)
    return dedup_top1(df, keys, order)


def distinct_count(df: DataFrame, column: str, name: str = "distinct_count") -> DataFrame:
    """Number of distinct values of ``column`` as a one-row frame.

    ``select(c).distinct()`` counts null as a value, as the flows do; the
    distinct runs as a two-phase aggregate, never on the driver.
    """
    return df.select(column).distinct().agg(F.count(F.lit(1)).alias(name))
