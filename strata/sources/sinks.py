"""Writes: path or catalog targets, counted writes, read-back checks, schema DDL."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.sources.readers import read_file


@dataclass(frozen=True)
class SinkSpec:
    """Where and how to write; ``kind`` is ``"path"`` or ``"table"``."""

    target: str
    kind: str = "path"
    format: str = "parquet"
    mode: str = "overwrite"
    options: Mapping[str, object] = field(default_factory=dict)
    partition_by: Sequence[str] = ()
    keep_schema: bool = False


# The default output section of the generic copy flow.
DEFAULT_OUTPUT = {"format": "parquet", "mode": "overwrite"}


def write_target(df: DataFrame, spec: SinkSpec) -> None:
    """Write to a path (``save``) or a catalog table (``saveAsTable``).

    An overwrite of a table replaces its schema as well (the parquet
    equivalent of ``overwriteSchema``), unless ``keep_schema`` is set: then a
    frame whose column names or types differ from the existing table's is
    refused before anything is written.
    """
    if spec.keep_schema and spec.kind == "table" and df.sparkSession.catalog.tableExists(spec.target):
        there = df.sparkSession.table(spec.target).dtypes
        if there != df.dtypes:
            raise ValueError(f"{spec.target} has the columns {there}, the frame has {df.dtypes}")
    w = df.write.format(spec.format).mode(spec.mode)
    for k, v in spec.options.items():
        w = w.option(k, v)
    if spec.partition_by:
        w = w.partitionBy(*spec.partition_by)
    if spec.kind == "table":
        w.saveAsTable(spec.target)
    else:
        w.save(spec.target)


def write_file(df: DataFrame, output_path: str, file_format: str | None = None,
               mode: str | None = None) -> None:
    """Generic write with config defaults for format and mode."""
    write_target(df, SinkSpec(output_path, "path", file_format or DEFAULT_OUTPUT["format"],
                              mode or DEFAULT_OUTPUT["mode"]))


def write_counted(df: DataFrame, spec: SinkSpec) -> int:
    """Write and return the number of rows written, observed during the write
    itself (no second job)."""
    obs = Observation(f"rows_{abs(hash(spec.target))}")
    write_target(df.observe(obs, F.count(F.lit(1)).alias("rows")), spec)
    return int(obs.get["rows"])


def read_target(spark: SparkSession, spec: SinkSpec) -> DataFrame:
    if spec.kind == "table":
        return spark.table(spec.target)
    return read_file(spark, spec.target, spec.format)


@contextmanager
def session_setting(spark: SparkSession, key: str, value: str):
    """What is run inside has ``key`` set to ``value``; the session's own setting comes back."""
    own = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if own is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, own)


#: Shuffle files go when the write that made them ends, not when the driver happens to collect its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def write_in_passes(df: DataFrame, keys: Sequence[str], passes: int, build: Callable[[DataFrame], DataFrame], path: str) -> DataFrame:
    """``build(df)`` written to ``path``, one share of the ``keys`` after another, and read back.

    For a ``build`` that treats rows of different ``keys`` apart: each pass
    reads ``df`` and shuffles the rows of its share alone, so shuffle files
    take one pass's disk instead of the whole frame's.
    """
    spark = df.sparkSession
    for k in range(passes):
        # not `hash`, by which Spark deals rows out: a share would go to a few partitions only
        share = df.where(F.pmod(F.xxhash64(*keys), F.lit(passes)) == k)
        with session_setting(spark, SHUFFLE_CLEANUP, "true"):
            build(share).write.mode("append" if k else "overwrite").parquet(path)
    return read_file(spark, path, "parquet")


def remove_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder of the shared file system that this flow wrote itself and no step reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def write_all(spark: SparkSession, outputs: Mapping[str, tuple[DataFrame | None, SinkSpec]]) -> DataFrame:
    """Write each built output, skip unbuilt (None) ones; return ``name, target, row_count``.

    The counts are observed during the writes (one job per output, none extra).
    The shuffle files of an output go before the next one is written.
    """
    with session_setting(spark, SHUFFLE_CLEANUP, "true"):
        rows = [(name, spec.target, write_counted(df, spec)) for name, (df, spec) in outputs.items() if df is not None]
    return spark.createDataFrame(rows, "name string, target string, row_count bigint")


def verify_readback(spark: SparkSession, specs: Mapping[str, SinkSpec] | Sequence[SinkSpec]) -> DataFrame:
    """Count each written target by reading it back: ``name, target, row_count``, one job."""
    named = specs.items() if isinstance(specs, Mapping) else [(s.target, s) for s in specs]
    parts = [read_target(spark, s).agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(n).alias("name"), F.lit(s.target).alias("target"), "row_count") for n, s in named]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


#: Characters at which a multi-line JSON document is closed.
DOCUMENT_CHARS = 8 << 20


def write_json_documents(df: DataFrame, path: str, records_per_file: int | None = None,
                         document_chars: int = DOCUMENT_CHARS) -> None:
    """Write multi-line JSON in a flat folder: each file holds one JSON array of records.

    A task cuts its own rows into documents, one file each, so nothing is
    shuffled or counted and a document is bounded whatever the keys are: it is
    closed at ``document_chars`` characters (one record beyond at most) or
    ``records_per_file`` records, if given. Readers parse a document whole, so
    it must suit their memory; but every file costs the driver a commit and a
    listing, so many small ones take longer than their rows.

    The files are gzip, which JSON readers open by its ending: field names and
    weekday flags repeat in each record, so plain text takes about ten times the disk.
    """
    def documents(batches):
        part, size = [], 0
        for batch in batches:
            for record in batch["value"]:
                part.append(record)
                size += len(record) + 1
                if size >= document_chars or len(part) == records_per_file:
                    yield pd.DataFrame({"value": ["[" + ",".join(part) + "]"]})
                    part, size = [], 0
        if part:
            yield pd.DataFrame({"value": ["[" + ",".join(part) + "]"]})

    records = df.select(F.to_json(F.struct(*df.columns)).alias("value"))
    records.mapInPandas(documents, "value string").write.mode("overwrite").option("maxRecordsPerFile", 1) \
        .option("compression", "gzip").option("zlib.compress.level", "THREE").text(path)


def ensure_schemas(spark: SparkSession, names: Sequence[str], location_root: str | None = None,
                   comment: str | None = None) -> None:
    """``CREATE SCHEMA IF NOT EXISTS`` for each name (optionally under a shared location)."""
    for n in names:
        ddl = f"CREATE SCHEMA IF NOT EXISTS {n}"
        if comment:
            ddl += " COMMENT '" + comment.replace("'", "''") + "'"
        if location_root:
            ddl += f" LOCATION '{location_root.rstrip('/')}/{n}'"
        spark.sql(ddl)


def describe_schema(spark: SparkSession, df: DataFrame) -> DataFrame:
    """The schema as rows ``position, column_name, data_type, nullable`` (driver metadata only)."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "position int, column_name string, data_type string, nullable boolean")


def describe_table(spark: SparkSession, fqn: str) -> DataFrame:
    """Column rows of ``DESCRIBE TABLE EXTENDED``: ``col_name, data_type`` (the
    detailed table information after the first blank row is left out)."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {fqn}").collect()  # one row per column + table facts
    cols = []
    for r in rows:
        if not r.col_name or r.col_name.startswith("#"):
            break
        cols.append((r.col_name, r.data_type))
    return spark.createDataFrame(cols, "col_name string, data_type string")


def list_schemas(spark: SparkSession) -> DataFrame:
    """The catalog's schemas as rows ``name, description, location``."""
    return spark.createDataFrame([(d.name, d.description, d.locationUri) for d in spark.catalog.listDatabases()],
                                 "name string, description string, location string")


#: Files a task has open at once: one per value of the flag, null too, and one more, as Spark sorts what comes after the last allowed.
FLAG_WRITERS = 4


def write_flag_split(df: DataFrame, flag_col: str, root: str, file_format: str = "parquet") -> tuple[str, str]:
    """Write both sides of a split in one job: partitioned by the boolean flag.

    The cleansing plan that produced ``df`` runs once (not once per side);
    each task writes at most one file per side, both open at once, with no
    shuffle and no sort by the flag (which spills where a task has many rows).
    Returns the (clean, flagged) folders, which read back as ordinary tables
    without the flag column. A side with no rows is written as an empty table.
    """
    spark = df.sparkSession
    with session_setting(spark, "spark.sql.maxConcurrentOutputFileWriters", str(FLAG_WRITERS)):
        # static, whatever the cluster's setting: a side that has no rows this time must not keep those of the run before
        df.write.mode("overwrite").option("partitionOverwriteMode", "static").format(file_format).partitionBy(flag_col).save(root)
    sides = []
    for value in ("false", "true"):
        path = f"{root.rstrip('/')}/{flag_col}={value}"
        try:
            read_file(spark, path, file_format).schema
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            # the side has no rows, so no folder was written: give it an empty table of the same schema
            spark.createDataFrame([], df.drop(flag_col).schema).write.mode("overwrite").format(file_format).save(path)
        sides.append(path)
    return sides[0], sides[1]
