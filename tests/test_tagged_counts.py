"""Distinct counts of several columns by (key, column, value), and profiles by kind, equal the plain aggregates."""

import re

from pyspark.sql import functions as F

from strata.operators import gold, profile
from strata.queries import queries

ROWS = [(k % 3 if k % 7 else None, f"a{k % 5}" if k % 4 else None, f"b{k % 11}", None, k) for k in range(200)]
SCHEMA = "k int, x string, y string, z string, _value int"


def test_counts_equal_the_plain_aggregate(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    names = ["x", "y", "z"]
    measures = [gold.Measure("n", "count"), *(gold.Measure(f"n_{c}", "count_distinct", c) for c in names)]
    got = gold.group_summary(df, ["k"], measures)
    want = df.groupBy("k").agg(F.count("*").alias("n"), *[F.count_distinct(c).alias(f"n_{c}") for c in names])
    assert got.dtypes == want.dtypes
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert gold.group_summary(df.limit(0), ["k"], measures).count() == 0


def test_column_keys_and_column_inputs(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    measures = [gold.Measure("p", "count_distinct", F.upper("x")), gold.Measure("q", "count_distinct", "y")]
    keys = [(F.col("k") + 1).alias("next"), F.length("y").alias("len")]
    got = gold.group_summary(df, keys, measures, order_by=["next", "len"])
    want = df.groupBy(*keys).agg(F.count_distinct(F.upper("x")).alias("p"), F.count_distinct("y").alias("q")).orderBy("next", "len")
    assert got.columns == want.columns and list(map(tuple, got.collect())) == list(map(tuple, want.collect()))


def test_other_measures_and_mixed_types_keep_the_plain_aggregate(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    mixed = [gold.Measure("p", "count_distinct", "x"), gold.Measure("q", "count_distinct", "_value")]
    other = [gold.Measure("p", "count_distinct", "x"), gold.Measure("q", "count_distinct", "y"), gold.Measure("top", "max", "_value")]
    for measures in (mixed, other):
        assert {r.k: r.p for r in gold.group_summary(df, ["k"], measures).collect()} == {r.k: r.p for r in df.groupBy("k").agg(F.count_distinct("x").alias("p")).collect()}


def test_only_key_column_and_value_are_shuffled(spark, sf_dir):
    for key in ("agg_count_distinct", "gold_station_frequency"):
        plan = queries()[key](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        exchanged = re.findall(r"Exchange hashpartitioning\(([^)]*), \d+\)", plan)
        assert any("_column" in x and "_value" in x for x in exchanged)
        assert not any(c in x for x in exchanged for c in ("l_partkey", "l_orderkey", "trainNumber"))


def test_numeric_profiles_stay_in_a_hash_aggregate(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    plan = profile.profile_describe(df)._jdf.queryExecution().executedPlan().toString()
    assert all("stddev" not in line for line in plan.split("\n") if "SortAggregate" in line) and "HashAggregate" in plan
    rows = {r.column_name: r for r in profile.profile_describe(df).collect()}
    assert list(rows) == ["k", "x", "y", "z", "_value"] and rows["_value"]["mean"] == 99.5 and (rows["x"].min_text, rows["x"].max_text, rows["z"]["count"]) == ("a0", "a4", 0)
    assert [r.column_name for r in profile.profile_describe(df, ["y"]).collect()] == ["y"]
