"""Typed column profiles (long form): ``describe`` and ``summary``.

Spark's own ``describe()``/``summary()`` return every statistic as a string
in a wide frame; these return one typed row per column, text columns included
(``min_text``, ``max_text``). Quartiles come from KLL sketches of a fixed size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")


def numeric_columns(df: DataFrame) -> list[str]:
    return [c for c, t in df.dtypes if t in NUMERIC or t.startswith("decimal")]


def profiled_columns(df: DataFrame) -> list[str]:
    """Numeric and text columns: those that the engine's own ``describe`` covers."""
    numeric = set(numeric_columns(df))
    return [c for c, t in df.dtypes if c in numeric or t == "string"]


def _statistics(df: DataFrame, cols: Sequence[str], digits: int) -> tuple[list[tuple[Column, str]], list[list[Column]]]:
    """Aggregates of all columns with their names, and for each column the fields of its row."""
    numeric, aggs, rows = set(numeric_columns(df)), [], []

    def add(name: str, aggregate: Column) -> None:
        aggs.append((aggregate.alias(name), name))

    none = F.lit(None)
    for i, c in enumerate(cols):
        add(f"n{i}", F.count(c))
        if c in numeric:
            x = F.col(c).cast("double")
            add(f"m{i}", F.round(F.avg(x), digits))
            add(f"s{i}", F.round(F.stddev_samp(x), digits))
            add(f"lo{i}", F.min(x))
            add(f"hi{i}", F.max(x))
            values = [F.col(f"m{i}"), F.col(f"s{i}"), F.col(f"lo{i}"), F.col(f"hi{i}")]
            texts = [none.cast("string")] * 2
        else:
            add(f"lo{i}", F.min(c))
            add(f"hi{i}", F.max(c))
            values, texts = [none.cast("double")] * 4, [F.col(f"lo{i}"), F.col(f"hi{i}")]
        fields = [F.lit(c), F.col(f"n{i}"), *values, *texts]
        names = ["column_name", "count", "mean", "stddev", "min", "max", "min_text", "max_text"]
        rows.append([f.alias(n) for f, n in zip(fields, names)])
    return aggs, rows


def _aggregated(df: DataFrame, cols: Sequence[str], digits: int) -> tuple[DataFrame, list[list[Column]]]:
    """One row of all statistics, and for each column the fields of its row.

    The extremes of text columns can't be kept in a hash aggregate, so they
    have one of their own; the numeric columns' stays compiled.
    """
    aggs, rows = _statistics(df, cols, digits)
    numeric = set(numeric_columns(df))
    texts = {f"{p}{i}" for i, c in enumerate(cols) if c not in numeric for p in ("n", "lo", "hi")}
    parts = [[a for a, n in aggs if (n in texts) == of] for of in (False, True)]
    one, *more = [df.agg(*p) for p in parts if p]
    return (one.crossJoin(more[0]) if more else one), rows  # one row by one row


def profile_describe(df: DataFrame, columns: Sequence[str] | None = None, digits: int = 4) -> DataFrame:
    """``column_name, count, mean, stddev, min, max, min_text, max_text`` per numeric or text column, one pass over either kind."""
    cols = list(columns) if columns else profiled_columns(df)
    if not cols:
        return df.limit(0)
    stats, rows = _aggregated(df, cols, digits)
    return stats.select(F.inline(F.array(*[F.struct(*r) for r in rows])))


def quartiles(df: DataFrame, cols: Sequence[str], k: int = 400, groups: int = 256) -> DataFrame:
    """One row: an array of the three approximate quartiles of each column (``q0``, ``q1``, …).

    Each of ``groups`` groups of tasks merges its tasks' KLL sketches (a few
    KB each, whatever the rows), then one task merges one sketch per group, so
    no task's input grows with the number of tasks. A quartile's rank is within
    about 2.7/k of the true one.
    """
    sketches = df.groupBy(F.pmod(F.spark_partition_id(), F.lit(groups)).alias("_group")).agg(
        *[F.kll_sketch_agg_double(F.col(c).cast("double"), k).alias(f"_{i}") for i, c in enumerate(cols)])
    merged = sketches.agg(*[F.kll_merge_agg_double(f"_{i}", k).alias(f"_{i}") for i in range(len(cols))])
    ranks = F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))
    return merged.select(*[
        F.when(F.kll_sketch_get_n_double(f"_{i}") > 0, F.kll_sketch_get_quantile_double(f"_{i}", ranks)).alias(f"q{i}")
        for i in range(len(cols))])


def profile_summary(df: DataFrame, columns: Sequence[str] | None = None, digits: int = 4, k: int = 400) -> DataFrame:
    """``describe`` plus approximate quartiles ``p25, p50, p75`` (null for text columns)."""
    cols = list(columns) if columns else profiled_columns(df)
    numeric = [c for c in cols if c in set(numeric_columns(df))]
    stats, rows = _aggregated(df, cols, digits)
    if numeric:
        stats = stats.crossJoin(quartiles(df, numeric, k))  # one row by one row
    at = {c: F.col(f"q{i}") for i, c in enumerate(numeric)}
    points = lambda c, i: F.get(at[c], F.lit(i)) if c in at else F.lit(None).cast("double")
    entries = [F.struct(*row, *[points(c, i).alias(p) for i, p in enumerate(("p25", "p50", "p75"))]) for c, row in zip(cols, rows)]
    return stats.select(F.inline(F.array(*entries)))
