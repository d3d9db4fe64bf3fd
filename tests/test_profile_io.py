"""Profiles against brute force; sources and sinks round trips."""

import pandas as pd

from strata.operators.profile import profile_describe, profile_summary
from strata.session import scratch_path
from strata.sources import readers, sinks

COLS = ["l_quantity", "l_extendedprice", "l_discount"]


def test_profiles_against_pandas(spark, sf_dir):
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    pdf = li.select(*COLS).toPandas()
    desc = {r.column_name: r for r in profile_describe(li, COLS).collect()}
    summ = {r.column_name: r for r in profile_summary(li, COLS).collect()}
    n = len(pdf)
    for c in COLS:
        s = pdf[c]
        assert desc[c]["count"] == n and desc[c]["min"] == s.min() and desc[c]["max"] == s.max()
        assert abs(desc[c]["mean"] - round(s.mean(), 4)) < 1e-9
        assert abs(desc[c]["stddev"] - round(s.std(ddof=1), 4)) < 1e-9
        ordered = s.sort_values().reset_index(drop=True)
        for q, name in [(0.25, "p25"), (0.5, "p50"), (0.75, "p75")]:
            v = summ[c][name]
            # approximate quartile: the returned value's rank is within the sketch error of q * n
            lo = (ordered < v).sum()
            hi = (ordered <= v).sum()
            assert lo - n * 0.02 <= q * n <= hi + n * 0.02


def test_round_trips(spark, sf_dir):
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    root = scratch_path(spark, "test-io")
    out = sinks.write_all(spark, {
        "n": (nation, sinks.SinkSpec(f"{root}/n")),
        "skip": (None, sinks.SinkSpec(f"{root}/skip")),
        "csv": (nation, sinks.SinkSpec(f"{root}/csv", format="csv", options={"header": "true"})),
    })
    assert {r.name: r.row_count for r in out.collect()} == {"n": 25, "csv": 25}
    back = sinks.verify_readback(spark, {"n": sinks.SinkSpec(f"{root}/n")}).first()
    assert back.row_count == 25
    strings = readers.read_csv(spark, f"{root}/csv")
    assert dict(strings.dtypes)["n_nationkey"] == "string"
    typed = readers.read_csv(spark, f"{root}/csv", schema="n_nationkey int, n_name string, n_regionkey int")
    assert sorted(typed.collect()) == sorted(nation.collect())
    inv = readers.file_inventory(spark, f"{root}/n", glob="*.parquet")
    assert inv.columns == ["path", "length", "modificationTime"] and inv.count() >= 1
    schema_rows = sinks.describe_schema(spark, nation).collect()
    assert [(r.column_name, r.data_type) for r in schema_rows] == [
        ("n_nationkey", "int"), ("n_name", "string"), ("n_regionkey", "int")]


def test_json_documents_bounded(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_orderstatus")
    path = scratch_path(spark, "test-json-docs")
    sinks.write_json_documents(orders, path, records_per_file=200)
    back = readers.read_json(spark, path, multiline=True)
    assert back.count() == orders.count()
    docs = spark.read.text(path).count()            # one line (one array) per file
    assert docs == -(-orders.count() // 200)
    assert pd.Series([1]).sum() == 1


def test_flag_split_one_job_and_empty_side(spark, sf_dir):
    from pyspark.sql import functions as F

    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    root = scratch_path(spark, "test-flag-split")
    clean, flagged = sinks.write_flag_split(nation.withColumn("_bad", F.col("n_nationkey") < 0), "_bad", root)
    assert readers.read_layer(spark, clean).count() == 25
    empty = readers.read_layer(spark, flagged)
    assert empty.count() == 0 and empty.columns == nation.columns
