"""Multi-line JSON documents: few files however many records, and none without a bound."""

from pyspark.sql import functions as F

from strata.plans import inputs, trains
from strata.session import scratch_path
from strata.sources import readers, sinks


def _rows(spark, n, tasks=1):
    return spark.range(0, n, 1, tasks).select("id", F.when(F.col("id") % 7 > 0, F.concat(F.lit("line\n[é,"), "id")).alias("v"))


def test_files_follow_bytes_not_records(spark):
    df = _rows(spark, 25_000)
    path = scratch_path(spark, "test-json-few-files")
    sinks.write_json_documents(df, path)
    assert spark.read.text(path).count() == 1   # across Arrow batches too
    back = readers.read_json(spark, path, multiline=True, schema=df.schema)
    assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0


def test_documents_end_at_their_characters_and_records(spark):
    df = _rows(spark, 5000, 2)
    path = scratch_path(spark, "test-json-chars")
    sinks.write_json_documents(df, path, document_chars=10_000)
    sizes = spark.read.text(path).agg(F.max(F.length("value")).alias("most"), F.count("*").alias("n")).first()
    assert sizes.most < 10_100 and sizes.n > 10
    assert readers.read_json(spark, path, multiline=True, schema=df.schema).exceptAll(df).count() == 0
    both = scratch_path(spark, "test-json-both")
    sinks.write_json_documents(df, both, records_per_file=50, document_chars=1_000_000)
    assert spark.read.text(both).count() == 100
    assert readers.read_json(spark, both, multiline=True).count() == 5000


def test_no_rows_give_no_document(spark):
    df = _rows(spark, 0)
    path = scratch_path(spark, "test-json-none")
    sinks.write_json_documents(df, path)
    assert readers.read_json(spark, path, multiline=True, schema=df.schema).count() == 0


def test_documents_take_a_fraction_of_their_characters_on_disk(spark, sf_dir):
    df = inputs.trains_raw(spark, sf_dir)
    path = scratch_path(spark, "test-json-disk")
    sinks.write_json_documents(df, path)
    on_disk = readers.file_inventory(spark, path).agg(F.sum("length")).first()[0]
    assert on_disk * 5 < spark.read.text(path).agg(F.sum(F.length("value"))).first()[0]
    for schema in (trains.RAW_SCHEMA, None):   # read by the given structure and by an inferred one
        back = trains.bronze_stops(readers.read_json(spark, path, multiline=True, schema=schema))
        want = trains.bronze_stops(df)
        assert back.count() == want.count() and back.exceptAll(want).count() == 0
