"""The layer operators on a file stream: incremental files, idempotent batches."""

import pytest
from pyspark.sql import functions as F

from strata.operators.bronze import audit_columns
from strata.plans import inputs, trips
from strata.session import scratch_path
from strata.sources.readers import SourceSpec, read_layer
from strata.sources.sinks import SinkSpec
from strata.streaming import stream_layer, stream_split


def test_stream_bronze_and_split(spark, sf_dir):
    raw = inputs.trips_raw(spark, sf_dir)
    landing = scratch_path(spark, "stream-landing")
    first, second = raw.filter(F.hour("lpep_dropoff_datetime") < 12), raw.filter(F.hour("lpep_dropoff_datetime") >= 12)
    first.write.parquet(f"{landing}/part1")
    src = SourceSpec(f"{landing}/*", "parquet", schema=raw.schema)
    bronze_sink = SinkSpec(scratch_path(spark, "stream-bronze"))
    ckpt = scratch_path(spark, "stream-bronze-ckpt")
    stream_layer(spark, src, lambda df: audit_columns(df, literals={"_batch_id": 1}), bronze_sink, ckpt) \
        .awaitTermination()
    assert read_layer(spark, bronze_sink.target).count() == first.count()
    second.write.parquet(f"{landing}/part2")
    stream_layer(spark, src, lambda df: audit_columns(df, literals={"_batch_id": 2}), bronze_sink, ckpt) \
        .awaitTermination()
    bronze = read_layer(spark, bronze_sink.target)
    assert bronze.count() == raw.count()                     # only the new file was added
    with pytest.raises(TypeError):
        stream_layer(spark, src, lambda df: df, bronze_sink)  # a run must name its progress folder

    clean_sink, bad_sink = SinkSpec(scratch_path(spark, "stream-clean")), SinkSpec(scratch_path(spark, "stream-bad"))
    stream_split(spark, src, [r.bad for r in trips.critical_rules()], clean_sink, bad_sink,
                 scratch_path(spark, "stream-split-ckpt")).awaitTermination()
    good, bad = trips.split_trips(raw)
    assert read_layer(spark, clean_sink.target).count() == good.count()
    assert read_layer(spark, bad_sink.target).count() == bad.count()
