"""Data quality: rule engine, null profiles, quarantine, reconciliation, layer report.

Everything is computed in as few passes as possible: all rules of a rule set
are one ``agg`` of ``count_if`` expressions (one job, however many rules),
and the results are turned into rows with ``inline`` over a literal array —
a one-row → n-row projection with no shuffle and no join.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A named check; ``bad`` is true for a row that violates it."""

    name: str
    category: str
    bad: Column


def _fail_pct(failed: Column, total: Column) -> Column:
    return F.round(F.try_divide(failed.cast("double"), total.cast("double")) * 100, 2)


def run_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Evaluate every rule in one pass.

    Returns ``rule_name, category, failed_rows, fail_pct, status`` with one row
    per rule. A rule whose predicate is null for a row does not count that
    row as failed (it did not fire); completeness rules catch the nulls.
    """
    aggs = [F.count(F.lit(1)).alias("_total")]
    aggs += [F.count_if(r.bad).alias(f"_rule{i}") for i, r in enumerate(rules)]
    entries = F.array(*[
        F.struct(F.lit(r.name).alias("rule_name"), F.lit(r.category).alias("category"),
                 F.col(f"_rule{i}").alias("failed_rows"))
        for i, r in enumerate(rules)
    ])
    return (
        df.agg(*aggs)
        .select("_total", F.inline(entries))
        .select(
            "rule_name", "category", "failed_rows",
            _fail_pct(F.col("failed_rows"), F.col("_total")).alias("fail_pct"),
            F.when(F.col("failed_rows") == 0, F.lit("PASS")).otherwise(F.lit("FAIL")).alias("status"),
        )
    )


def dq_score(results: DataFrame) -> DataFrame:
    """Rules evaluated / passed / failed and the percentage passed (1 decimal)."""
    return results.agg(
        F.count(F.lit(1)).alias("rules_evaluated"),
        F.count_if(F.col("status") == "PASS").alias("rules_passed"),
        F.count_if(F.col("status") == "FAIL").alias("rules_failed"),
    ).withColumn("dq_score", F.round(
        F.try_divide(F.col("rules_passed").cast("double"), F.col("rules_evaluated").cast("double")) * 100, 1))


def dq_by_category(results: DataFrame) -> DataFrame:
    """Failing rules per category with their summed failed rows, largest first."""
    return (
        results.filter(F.col("status") == "FAIL")
        .groupBy("category")
        .agg(F.count(F.lit(1)).alias("failed_rules"), F.sum("failed_rows").alias("total_failed_rows"))
        .orderBy(F.col("total_failed_rows").desc())
    )


def any_of(conditions: Sequence[Column]) -> Column:
    """OR-reduction of predicates, null-safe: unknown counts as not violated."""
    return F.coalesce(functools.reduce(operator.or_, conditions), F.lit(False))


def quarantine_split(df: DataFrame, conditions: Sequence[Column] | Column) -> tuple[DataFrame, DataFrame]:
    """Split into (clean, quarantine) on one null-safe condition.

    ``filter(c)`` + ``filter(~c)`` loses rows whose condition is null; with
    ``coalesce(c, false)`` every input row lands on exactly one side.
    """
    bad = any_of(conditions if isinstance(conditions, (list, tuple)) else [conditions])
    return df.filter(~bad), df.filter(bad)


def flag_rows(df: DataFrame, conditions: Sequence[Column], name: str = "_is_quarantined") -> DataFrame:
    """Add the quarantine flag, so both sides can be written from one scan."""
    return df.withColumn(name, any_of(conditions))


def quarantine_reason(df: DataFrame, rules: Sequence[Rule], reason: str = "DQ_CRITICAL_FAILURE",
                      reason_col: str = "_quarantine_reason", rules_col: str = "_failed_rules") -> DataFrame:
    """Quarantined rows with a constant reason and the names of the rules they broke."""
    fired = F.array_compact(F.array(*[F.when(r.bad, F.lit(r.name)) for r in rules]))
    return (
        df.filter(any_of([r.bad for r in rules]))
        .withColumns({reason_col: F.lit(reason), rules_col: fired})
    )


def reconcile(df: DataFrame, conditions: Sequence[Column]) -> DataFrame:
    """Accounting of a split in a single pass over the input.

    ``input_rows = clean_rows + quarantine_rows`` holds by construction of the
    null-safe split; ``balanced`` states it for the report.
    """
    bad = any_of(conditions)
    return df.agg(
        F.count(F.lit(1)).alias("input_rows"),
        F.count_if(~bad).alias("clean_rows"),
        F.count_if(bad).alias("quarantine_rows"),
    ).withColumn("balanced", F.col("input_rows") == F.col("clean_rows") + F.col("quarantine_rows"))


def reconcile_outputs(input_df: DataFrame, clean: DataFrame, quarantine: DataFrame) -> DataFrame:
    """Accounting of already-written outputs: three counts, one row, no join."""
    counts = (
        input_df.agg(F.count(F.lit(1)).alias("n")).select(F.lit("input_rows").alias("k"), "n")
        .unionByName(clean.agg(F.count(F.lit(1)).alias("n")).select(F.lit("clean_rows").alias("k"), "n"))
        .unionByName(quarantine.agg(F.count(F.lit(1)).alias("n")).select(F.lit("quarantine_rows").alias("k"), "n"))
    )
    wide = counts.groupBy().pivot("k", ["input_rows", "clean_rows", "quarantine_rows"]).agg(F.first("n"))
    return wide.withColumn("balanced", F.col("input_rows") == F.col("clean_rows") + F.col("quarantine_rows"))


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column: ``column_name, null_count, total_rows, null_pct``, most nulls first.

    The total and all null counts come from the same single aggregate.
    """
    cols = list(columns) if columns else df.columns
    aggs = [F.count(F.lit(1)).alias("_total")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"_null{i}") for i, c in enumerate(cols)]
    entries = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"_null{i}").alias("null_count"))
        for i, c in enumerate(cols)
    ])
    return (
        df.agg(*aggs)
        .select(F.col("_total").alias("total_rows"), F.inline(entries))
        .select("column_name", "null_count", "total_rows",
                _fail_pct(F.col("null_count"), F.col("total_rows")).alias("null_pct"))
        .orderBy(F.col("null_count").desc(), "column_name")
    )


def null_profile_wide(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """A single row with the null count of every column, named after the column."""
    cols = list(columns) if columns else df.columns
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])


def layer_report(entries: Sequence[tuple[str, str, DataFrame | int | None]],
                 baseline: tuple[str, str] | None = None) -> DataFrame:
    """Row counts per (layer, table); a table that is missing reports ``N/A``, a number is a count taken before.

    With ``baseline`` (a ``(layer, table)`` of ``entries``) each row also gets
    its retention against that table and the rows it no longer has
    (``removed_rows``: duplicates and quarantined rows). The baseline is a row
    of the report itself (a few rows, one per table), so nothing is counted
    twice and nothing runs before an action.
    """
    parts = []
    spark = next((f.sparkSession for _, _, f in entries if isinstance(f, DataFrame)), None)
    for layer, table, frame in entries:
        if frame is None:
            part = _known_row(spark, layer, table, None, "N/A")
        elif isinstance(frame, int):
            part = _known_row(spark, layer, table, frame, "OK")
        else:
            part = frame.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(layer).alias("layer"), F.lit(table).alias("table_name"),
                F.col("row_count"), F.lit("OK").alias("status"))
        parts.append(part)
    report = functools.reduce(DataFrame.unionByName, parts)
    if baseline is not None:
        is_base = (F.col("layer") == baseline[0]) & (F.col("table_name") == baseline[1])
        report = report.withColumn("_base", F.max(F.when(is_base, F.col("row_count"))).over(Window.partitionBy()))
        report = report.withColumns({
            "retention_pct": F.round(F.try_divide(F.col("row_count").cast("double") * 100, F.col("_base").cast("double")), 1),
            "removed_rows": F.col("_base") - F.col("row_count"),
        }).drop("_base")
    return report


def _known_row(spark, layer: str, table: str, row_count: int | None, status: str) -> DataFrame:
    """The report row of a table that was not built, or whose count is known."""
    if spark is None:
        from pyspark.sql import SparkSession
        spark = SparkSession.getActiveSession()
    return spark.range(1).select(F.lit(layer).alias("layer"), F.lit(table).alias("table_name"),
                                 F.lit(row_count).cast("bigint").alias("row_count"), F.lit(status).alias("status"))
