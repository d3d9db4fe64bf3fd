"""Bronze-layer operators: audit columns, renames, row hashes, flattening."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.derive import row_hash


def audit_columns(df: DataFrame, *, timestamp: str | None = "_ingested_at",
                  literals: Mapping[str, object] | None = None) -> DataFrame:
    """Add the ingest timestamp and literal lineage columns in one projection.

    ``literals`` maps column → constant, e.g. ``{"_source_file": "x.csv",
    "_batch_id": 1}`` or ``{"_quarantine_reason": "DQ_CRITICAL_FAILURE"}``.
    """
    cols: dict[str, Column] = {}
    if timestamp:
        cols[timestamp] = F.current_timestamp()
    for name, value in (literals or {}).items():
        cols[name] = F.lit(value)
    return df.withColumns(cols) if cols else df


def rename_map(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by mapping in one projection; names absent from ``df`` are ignored."""
    present = {old: new for old, new in mapping.items() if old in df.columns}
    return df.withColumnsRenamed(present) if present else df


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop columns; absent names are ignored."""
    return df.drop(*names)


def business_columns(df: DataFrame, audit_prefix: str = "_") -> list[str]:
    """Columns that are not audit columns (audit columns start with ``_``)."""
    return [c for c in df.columns if not c.startswith(audit_prefix)]


def with_row_hash(df: DataFrame, columns: Sequence[str] | None = None,
                  name: str = "_row_hash") -> DataFrame:
    """Add a SHA-256 row hash over ``columns`` (default: all business columns)."""
    return df.withColumn(name, row_hash(list(columns) if columns else business_columns(df)))


def surrogate_id(df: DataFrame, name: str = "_record_id") -> DataFrame:
    """Unique (not dense, not stable across runs) 64-bit id, without a shuffle."""
    return df.withColumn(name, F.monotonically_increasing_id())


def computed_once(df: DataFrame) -> DataFrame:
    """``df`` whose columns are computed once, whatever reads them later.

    Catalyst moves a filter below the projection that makes its columns and
    computes their expressions there as well; it moves none below a generator,
    so the columns come out of one (``inline`` of an array of one row).
    """
    return df.select(F.inline(F.array(F.struct(*df.columns))))


def flatten_nested(df: DataFrame, *, keep: Sequence[str] = (),
                   struct_fields: Mapping[str, str] | None = None,
                   array_col: str, element_fields: Mapping[str, str],
                   keep_empty: bool = False) -> DataFrame:
    """One row per array element, with top-level and nested struct fields lifted.

    ``struct_fields`` maps output name → dotted path (``"MON": "runningDays.MON"``);
    ``element_fields`` maps output name → field of the array element. Rows whose
    array is empty or null vanish unless ``keep_empty`` (then ``explode_outer``).

    They vanish by their missing position: for a plain ``explode`` Catalyst
    adds a filter on the array's size below it, and where the array is
    computed there, the whole array is built a second time for that filter.
    """
    first = [F.col(c) for c in keep]
    first += [F.col(path).alias(alias) for alias, path in (struct_fields or {}).items()]
    if keep_empty:
        df = df.select(*first, F.explode_outer(F.col(array_col)).alias("_element"))
    else:
        df = df.select(*first, F.posexplode_outer(F.col(array_col)).alias("_position", "_element")).where("_position is not null")
    second = list(keep) + list((struct_fields or {}).keys())
    second += [F.col(f"_element.{field}").alias(alias) for alias, field in element_fields.items()]
    return df.select(*second)
