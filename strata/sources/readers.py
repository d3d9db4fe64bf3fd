"""Reads: one generic, option-driven reader plus the format shortcuts the flows use."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


@dataclass(frozen=True)
class SourceSpec:
    """Where and how to read: a path (or table name when ``format == "table"``)."""

    path: str
    format: str = "parquet"
    options: Mapping[str, object] = field(default_factory=dict)
    schema: StructType | str | None = None


def read_file(spark: SparkSession, path: str, file_format: str = "csv",
              schema: StructType | str | None = None, **options) -> DataFrame:
    """``spark.read.format(f).options(**o).load(path)``; an explicit schema skips inference."""
    reader = spark.read.format(file_format)
    if schema is not None:
        reader = reader.schema(schema)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(path)


def read_source(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    """Read a ``SourceSpec``; ``format == "table"`` reads a catalog table."""
    if spec.format == "table":
        return spark.table(spec.path)
    return read_file(spark, spec.path, spec.format, spec.schema, **dict(spec.options))


def read_registry(spark: SparkSession, file_paths: Mapping[str, str]) -> dict[str, DataFrame]:
    """Read every configured source; the format is the key, CSV gets a header.

    Reads are lazy: nothing is scanned until a frame is used.
    """
    return {
        fmt: read_file(spark, path, fmt, **({"header": "true"} if fmt == "csv" else {}))
        for fmt, path in file_paths.items()
    }


def read_csv(spark: SparkSession, path: str, *, header: bool = True, infer: bool = False,
             multiline: bool = False, schema: StructType | str | None = None) -> DataFrame:
    """CSV with header. ``infer`` costs an extra full scan; prefer ``schema``."""
    opts = {"header": str(header).lower()}
    if infer and schema is None:
        opts["inferSchema"] = "true"
    if multiline:
        opts["multiLine"] = "true"
    return read_file(spark, path, "csv", schema, **opts)


def read_json(spark: SparkSession, path: str, *, multiline: bool = False,
              schema: StructType | str | None = None) -> DataFrame:
    """JSON lines, or whole-file documents (object or array of objects) with ``multiline``."""
    return read_file(spark, path, "json", schema, **({"multiLine": "true"} if multiline else {}))


def read_layer(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    """A layer table stored at a path."""
    return read_file(spark, path, file_format)


def file_inventory(spark: SparkSession, path: str, glob: str | None = None,
                   recursive: bool = True) -> DataFrame:
    """Files under ``path``: ``path, length, modificationTime``.

    Uses the ``binaryFile`` source with the ``content`` column pruned, so only
    file metadata is listed (in parallel on a cluster), no bytes are read.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select("path", "length", "modificationTime")
