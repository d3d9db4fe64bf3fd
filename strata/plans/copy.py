"""Generic copy: read every configured source, write one of them to the output."""

from __future__ import annotations

import functools
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources.readers import read_registry
from strata.sources.sinks import SinkSpec, verify_readback, write_counted


def run(spark: SparkSession, file_paths: Mapping[str, str], output: SinkSpec,
        write_key: str = "parquet") -> DataFrame:
    """Read every source, write ``write_key``'s frame, and return ``name, target, row_count``: what
    each source holds, and as ``copied`` what the output reads back."""
    frames = read_registry(spark, file_paths)
    write_counted(frames[write_key], output)
    counts = [frame.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("name"), F.lit(file_paths[name]).alias("target"), "row_count")
              for name, frame in frames.items()]
    return functools.reduce(DataFrame.unionByName, [*counts, verify_readback(spark, {"copied": output})])


def run_from_config(spark: SparkSession, cfg, write_key: str = "parquet") -> DataFrame:
    """Read every source of an ``IOConfig`` and write one to its configured output."""
    return run(spark, cfg.sources(), cfg.output, write_key)
