"""Disk of the trains flow: shuffle files go with the write that made them, and the largest come one share at a time."""

import os
import time

from pyspark.sql import functions as F

from strata.operators import gold
from strata.plans import inputs, trains
from strata.plans.layout import LayerLayout
from strata.session import scratch_path
from strata.sources import sinks


def _shuffle_bytes(spark) -> int:
    found = 0
    for top in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs():
        for folder, _, names in os.walk(top.getPath()):
            found += sum(os.path.getsize(f"{folder}/{n}") for n in names if n.startswith("shuffle_") and os.path.exists(f"{folder}/{n}"))
    return found


def _settles(spark, most: int, seconds: float = 20) -> bool:
    """Files are deleted in the background."""
    until = time.time() + seconds
    while _shuffle_bytes(spark) > most and time.time() < until:
        time.sleep(0.2)
    return _shuffle_bytes(spark) <= most


def test_written_outputs_leave_no_shuffle_files(spark):
    df = spark.range(200_000).select(F.sha2(F.col("id").cast("string"), 256).alias("k"))
    root = scratch_path(spark, "test-shuffle-files")
    before = _shuffle_bytes(spark)
    written = sinks.write_all(spark, {n: (df.groupBy("k").count().withColumn("n", F.lit(n)), sinks.SinkSpec(f"{root}/{n}")) for n in ("a", "b")})
    assert _settles(spark, before + 1_000_000)   # about 15 MB an output
    assert {(r.name, r.row_count) for r in written.collect()} == {("a", 200_000), ("b", 200_000)}
    assert spark.conf.get(sinks.SHUFFLE_CLEANUP, None) in (None, "false")


def test_split_sides_with_null_flags_and_hot_sides(spark):
    df = spark.range(0, 30_000, 1, 3).select("id", F.when(F.col("id") % 5 > 0, F.col("id") % 5 > 1).alias("_bad"))
    root = scratch_path(spark, "test-split-unsorted")
    sinks.write_flag_split(df, "_bad", root)
    back = spark.read.parquet(root)
    assert back.exceptAll(df).count() == 0 and back.count() == 30_000
    files = spark.read.parquet(f"{root}/_bad=false").select(F.input_file_name()).distinct().count()
    assert files == 3
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", None) in (None, "0")


def test_routes_in_passes_equal_those_in_one(spark, sf_dir):
    landing = scratch_path(spark, "test-passes-landing")
    sinks.write_json_documents(inputs.trains_raw(spark, sf_dir), landing)
    reports, routes = [], []
    for pass_stops in (trains.PASS_STOPS, 1500):
        layout = LayerLayout(scratch_path(spark, "test-passes"))
        reports.append(trains.run(spark, landing, layout, pass_stops=pass_stops).collect())
        target = layout.spec("gold", "route_summary").target
        routes.append(spark.read.parquet(target).collect())
        assert not os.path.exists(layout.spec("split", "routes").target.removeprefix("file:"))
    assert reports[0] == reports[1]
    assert sorted(routes[0], key=str) == sorted(routes[1], key=str) and len(routes[0]) > 1000
    order = [(-r.total_distance_km, r.trainNumber) for r in routes[1]]
    assert order == sorted(order)


def test_a_pass_shuffles_its_share_alone(spark):
    df = spark.range(9000).select((F.col("id") % 3000).cast("string").alias("k"), F.when(F.col("id") % 2 > 0, F.lit("x")).alias("t"))
    seen = []

    def build(part):
        seen.append(part.count())
        return part.groupBy("k", "t").count()

    out = sinks.write_in_passes(df, ["k", "t"], 4, build, scratch_path(spark, "test-share"))
    assert sum(seen) == 9000 and max(seen) < 3500
    assert sorted(out.collect(), key=str) == sorted(df.groupBy("k", "t").count().collect(), key=str)


def test_flags_of_a_group_are_shuffled_as_one_number(spark):
    rows = [("a", True, None, 3), ("a", False, None, 1), ("b", False, False, 7), ("b", None, True, None), (None, None, False, 2), (None, None, None, 9)]
    df = spark.createDataFrame(rows, "k string, f boolean, g boolean, i int")
    measures = [gold.Measure("f", "max_int", "f"), gold.Measure("n", "count"), gold.Measure("g.x", "max_int", "g"), gold.Measure("i", "max_int", "i"),
                gold.distinct_measure("d", "i")]
    got = gold.group_summary(df, ["k"], measures)
    want = df.groupBy("k").agg(*[m.expr() for m in measures])
    assert got.dtypes == want.dtypes and sorted(got.collect(), key=str) == sorted(want.collect(), key=str)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("bit_or(") == 1 and plan.count("max(") == 1
    wide = spark.range(100).select((F.col("id") % 7).alias("k"), *[F.when((F.col("id") + j) % 5 > 0, (F.col("id") * j) % 3 == 0).alias(f"c{j}") for j in range(40)])
    many = [gold.Measure(f"c{j}", "max_int", f"c{j}") for j in range(40)]
    assert sorted(gold.group_summary(wide, ["k"], many).collect()) == sorted(wide.groupBy("k").agg(*[m.expr() for m in many]).collect())
    same = gold.group_summary(df, ["f"], [gold.Measure("f", "max_int", "f"), gold.Measure("g", "max_int", "g")])
    assert same.columns == ["f", "f", "g"] and same.count() == 3
