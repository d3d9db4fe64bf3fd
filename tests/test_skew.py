"""Hot keys: one key (or one group of identical copies) holding most rows stays bounded."""

from pyspark.sql import functions as F

from strata.operators import bronze, dedup
from strata.plans import inputs, trains
from strata.session import scratch_path
from strata.sources import readers, sinks


def test_hot_order_gives_bounded_records_without_a_shuffle(spark, sf_dir):
    root = scratch_path(spark, "test-skew-tables")
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    one = li.first().asDict()
    hot = spark.range(3000).select(*[
        (F.lit(7).cast("bigint") if c == "l_orderkey" else
         F.col("id") if c == "l_partkey" else
         (F.col("id") % 7 + 1).cast("int") if c == "l_linenumber" else F.lit(one[c]).cast(t)).alias(c)
        for c, t in li.dtypes])
    li.unionByName(hot).write.parquet(f"{root}/lineitem.parquet")   # order 7 now holds about a third of all line items
    raw = inputs.trains_raw(spark, root)
    assert raw.agg(F.max(F.size("trainRoute"))).first()[0] == 2
    assert raw.filter(F.trim("trainNumber") == "7").count() >= 3000
    silver = trains.silver_stops(trains.bronze_stops(raw))
    assert "Exchange" not in silver._jdf.queryExecution().executedPlan().toString()
    assert silver.filter("trainNumber = '7'").count() >= 3000 - 31 + 740  # less null routes, plus second stops


def test_json_documents_bounded_for_identical_rows(spark):
    df = spark.range(5000).select(F.lit("same").alias("v"), F.lit(1).alias("k"))
    path = scratch_path(spark, "test-skew-json")
    sinks.write_json_documents(df, path, records_per_file=1000)
    docs = spark.read.text(path)
    records = docs.select(F.size(F.from_json("value", "array<struct<v:string,k:int>>")).alias("n"))
    assert records.agg(F.max("n")).first()[0] <= 1000 and docs.count() >= 5
    assert readers.read_json(spark, path, multiline=True).count() == 5000


def test_copies_collapse(spark):
    df = spark.range(20000).select((F.col("id") % 3 == 0).cast("int").alias("a"), F.lit("x").alias("b"))
    hashed = bronze.with_row_hash(df, ["a", "b"])
    out = dedup.dedup_hash(hashed, "_row_hash", whole_row=True)
    assert out.count() == 2
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and plan.count("HashAggregate") >= 2     # partial + final
