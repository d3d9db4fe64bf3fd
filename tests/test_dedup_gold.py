"""Deduplication and gold aggregates."""

import math

from pyspark.sql import functions as F

from strata.operators import dedup, gold
from strata.operators.bronze import flatten_nested, rename_map, with_row_hash


def test_dedup_top1_highest_with_stable_ties(spark):
    df = spark.createDataFrame([("a", 1, 10.0, "x"), ("a", 1, 30.0, "y"), ("a", 1, 30.0, "b"),
                                ("b", 2, None, "z"), ("b", 2, 5.0, "w")], "k string, k2 int, v double, t string")
    out = dedup.dedup_top1(df, ["k", "k2"], [F.col("v").desc_nulls_last()], [F.col("t").asc()])
    assert sorted(tuple(r) for r in out.collect()) == [("a", 1, 30.0, "b"), ("b", 2, 5.0, "w")]
    again = dedup.dedup_top1(out, ["k", "k2"], [F.col("v").desc_nulls_last()], [F.col("t").asc()])
    assert sorted(again.collect()) == sorted(out.collect())                       # idempotent


def test_dedup_top1_plans_partial_group_limit(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    out = dedup.dedup_top1(df, ["k"], [F.col("v").desc()])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert sorted(r.v for r in out.collect()) == [997, 998, 999]


def test_dedup_hash_and_key(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None), ("a", "b", None)], "x string, y string, z string")
    hashed = with_row_hash(df)
    assert dedup.dedup_hash(hashed).count() == 2
    one = dedup.dedup_key(spark.createDataFrame([(1, 5.0), (1, 7.0), (2, 1.0)], "k int, v double"), "k",
                          [F.col("v").desc()])
    assert sorted(tuple(r) for r in one.collect()) == [(1, 7.0), (2, 1.0)]
    assert dedup.distinct_count(df, "y").first()[0] == 2                          # null counts as a value


def test_measure_exact_average_rounds_ties_up(spark):
    df = spark.createDataFrame([("g", 1.00), ("g", 1.01)], "k string, x double")
    for exact in (True, False):
        assert gold.group_summary(df, ["k"], [gold.Measure("m", "avg", "x", round=2, exact=exact)]).first().m == 1.01


def test_measures_keep_fine_digits_nan_and_infinities(spark):
    rows = [("fine", 10.004)] * 1000 + [("half", 30.5), ("nan", 1.0), ("nan", float("nan")), ("inf", float("inf")), ("inf", None), ("none", None)]
    df = spark.createDataFrame(rows, "k string, x double")
    for exact in (True, False):
        ms = [gold.Measure("s", "sum", "x", round=2, exact=exact), gold.Measure("m", "avg", "x", round=1, exact=exact)]
        got = {r.k: (r.s, r.m) for r in gold.group_summary(df, ["k"], ms).collect()}
        assert got["fine"] == (10004.0, 10.0) and got["half"] == (30.5, 30.5) and got["none"] == (None, None)
        assert all(math.isnan(x) for x in got["nan"]) and got["inf"] == (math.inf, math.inf)


def test_pct_of_total_uses_all_rows(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), ("",)], "c string")
    g = gold.group_summary(df, ["c"], [gold.Measure("n", "count")])
    out = {r.c: r.pct_of_total for r in gold.with_pct_of_total(g, "n").filter(F.col("c") != "").collect()}
    assert out == {"a": 50.0, "b": 25.0}


def test_unpivot_frequency_weekday_order(spark):
    df = spark.createDataFrame([("t1", 1, 0, None), ("t2", 1, 1, 1)], "id string, MON int, TUE int, SUN int")
    rows = gold.unpivot_frequency(df, ["MON", "TUE", "SUN"], "day", "n", "pct").collect()
    assert [(r.day, r.n, r.pct) for r in rows] == [("MON", 2, 100.0), ("TUE", 1, 50.0), ("SUN", 1, 50.0)]


def test_stacked_summary_equals_tagged_union(spark, sf_dir):
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    ms = [gold.Measure("n", "count"), gold.Measure("q", "sum", "l_quantity", exact=True)]
    stacked = gold.stacked_group_summary(li, "side", "key", {"part": "l_partkey", "supp": "l_suppkey"}, ms)
    union = gold.union_tagged({
        "part": gold.group_summary(li, [F.col("l_partkey").alias("key")], ms),
        "supp": gold.group_summary(li, [F.col("l_suppkey").alias("key")], ms)}, "side")
    cols = ["side", "key", "n", "q"]
    assert sorted(stacked.select(cols).collect()) == sorted(union.select(cols).collect())


def test_flatten_nested_drops_or_keeps_empty(spark):
    df = spark.createDataFrame(
        [("t1", {"MON": True}, [{"sno": "1", "d": "5 kms"}, {"sno": "2", "d": "n/a"}]), ("t2", {"MON": False}, []),
         ("t3", {"MON": None}, None)],
        "id string, days struct<MON:boolean>, route array<struct<sno:string,d:string>>")
    kw = dict(keep=["id"], struct_fields={"MON": "days.MON"}, array_col="route",
              element_fields={"stop": "sno", "dist": "d"})
    assert flatten_nested(df, **kw).count() == 2
    kept = flatten_nested(df, keep_empty=True, **kw)
    assert kept.count() == 4 and kept.columns == ["id", "MON", "stop", "dist"]


def test_rename_map_ignores_absent(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert rename_map(df, {"a": "x", "zz": "y"}).columns == ["x", "b"]


def test_approximate_distinct_switch(spark, sf_dir):
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    exact = gold.group_summary(li, ["l_returnflag"], [gold.distinct_measure("n", "l_partkey")])
    approx = gold.group_summary(li, ["l_returnflag"], [gold.distinct_measure("n", "l_partkey", approximate=True)])
    e = {r.l_returnflag: r.n for r in exact.collect()}
    a = {r.l_returnflag: r.n for r in approx.collect()}
    assert e.keys() == a.keys() and all(abs(a[k] - e[k]) <= 0.1 * e[k] + 1 for k in e)
    assert "Expand" not in approx._jdf.queryExecution().executedPlan().toString()
