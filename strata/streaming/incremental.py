"""File-stream runners for the layer operators (``availableNow`` by default)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from strata.operators.quality import quarantine_split
from strata.sources.readers import SourceSpec
from strata.sources.sinks import SinkSpec, write_target


def _read_stream(spark: SparkSession, source: SourceSpec) -> DataFrame:
    if source.schema is None:
        raise ValueError("a file stream needs an explicit schema (no inference pass over a stream)")
    reader = spark.readStream.format(source.format).schema(source.schema)
    for k, v in source.options.items():
        reader = reader.option(k, v)
    return reader.load(source.path)


def stream_layer(spark: SparkSession, source: SourceSpec, transform: Callable[[DataFrame], DataFrame],
                 sink: SinkSpec, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Append ``transform(new rows)`` to a path sink; progress lives in ``checkpoint``.

    Every run of one sink must get the same folder: with another one, files
    already taken would be read again while the sink skips batches it knows.
    """
    out = transform(_read_stream(spark, source))
    writer = (out.writeStream.format(sink.format).outputMode("append")
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start(sink.target)


def stream_split(spark: SparkSession, source: SourceSpec, conditions: Sequence[Column],
                 clean: SinkSpec, quarantine: SinkSpec, checkpoint: str,
                 transform: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Split each micro-batch into clean and quarantined rows and write both.

    Each batch is written below ``batch_id=<n>`` with overwrite, so a batch
    replayed after a failure replaces its own output instead of adding to it.
    ``checkpoint`` must stay the same for all runs of the two sinks: it numbers
    the batches.
    """
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        frame = transform(batch) if transform else batch
        good, bad = quarantine_split(frame, list(conditions))
        for df, spec in ((good, clean), (bad, quarantine)):
            write_target(df, SinkSpec(f"{spec.target.rstrip('/')}/batch_id={batch_id}", "path",
                                      spec.format, "overwrite", spec.options))

    return (_read_stream(spark, source).writeStream.foreachBatch(write_batch)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
