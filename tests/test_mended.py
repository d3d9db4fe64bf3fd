"""Cases that used to go wrong: stale sides, lost stream files, clashing roles, bad dates, order, strict writes."""

import pytest
from pyspark.sql import functions as F

from strata.functions.derive import stay_days
from strata.operators import gold, profile, quality
from strata.operators.bronze import with_row_hash
from strata.operators.clean import resolve_roles, role_transform
from strata.operators.dedup import dedup_hash
from strata.plans import inputs, patients_roles, trains, trips
from strata.plans.layout import LayerLayout
from strata.queries import core, queries
from strata.session import scratch_path
from strata.sources import readers, sinks
from strata.sources.generate import gen_patients
from strata.streaming import stream_layer


def test_a_side_without_rows_does_not_keep_the_run_before(spark):
    df = spark.createDataFrame([(1, False), (2, True)], "v int, _bad boolean")
    root = scratch_path(spark, "stale-side")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        sinks.write_flag_split(df, "_bad", root)
        clean, bad = sinks.write_flag_split(df.where("v = 1"), "_bad", root)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert readers.read_layer(spark, clean).count() == 1 and readers.read_layer(spark, bad).count() == 0


def test_quarantine_lies_outside_the_silver_layer():
    layout = LayerLayout("/data")
    assert "/silver/" not in trains.layer_locations(layout)["quarantine"]


def test_land_run_land_run_takes_every_file_once(spark):
    landing, sink, progress = (scratch_path(spark, n) for n in ("landing", "stream-out", "stream-progress"))
    source = readers.SourceSpec(f"{landing}/*", "parquet", schema="id long")
    for at, n in ((0, 5), (5, 3)):
        spark.range(at, at + n).coalesce(1).write.parquet(f"{landing}/drop{at}")
        stream_layer(spark, source, lambda df: df, sinks.SinkSpec(sink), progress).awaitTermination()
        assert spark.read.parquet(sink).count() == at + n


def test_first_conversion_wins_and_types_guard(spark):
    df = spark.createDataFrame([(12.75, "English", 3, "2024-01-02", "Elective", "x")],
                               "`Coverage Amount` double, Language string, `Update Count` int, Discharge string, `Admission Type` string, `Page Amount` string")
    roles = resolve_roles(df, patients_roles.ROLE_RULES)
    row = role_transform(df, roles, ["proper", "upper", "date", "double", "int"]).first()
    assert row["Coverage Amount"] == 12.75 and row["Language"] == "English" and row["Update Count"] == 3
    assert str(row["Discharge"]) == "2024-01-02" and row["Admission Type"] == "ELECTIVE"


def test_a_bad_date_gives_no_stay_instead_of_an_error(spark):
    df = spark.createDataFrame([("2024-01-05", "2024-01-01"), ("bad", "2024-01-01"), (None, "x")], "d string, a string")
    assert [r.s for r in df.select(stay_days("d", "a").alias("s")).collect()] == [4, None, None]


def test_generated_columns_are_independent_and_never_repeat(spark):
    df = gen_patients(spark.range(100_000))
    assert df.select("Doctor", "Blood Type").distinct().count() == 64
    assert df.select("Medical Condition", "Admission Type").distinct().count() == 18
    ids = spark.createDataFrame([(5,), (1_000_008,)], "id long")
    assert gen_patients(ids).distinct().count() == 2


def test_profiles_cover_text_and_quartiles_are_close(spark):
    df = spark.range(20_001).select(F.col("id").cast("double").alias("x"), F.concat(F.lit("t"), F.col("id") % 7).alias("s"), F.lit(None).cast("int").alias("n"))
    rows = {r.column_name: r for r in profile.profile_summary(df).collect()}
    assert (rows["s"]["count"], rows["s"].min_text, rows["s"].max_text, rows["s"].p50) == (20_001, "t0", "t6", None)
    assert all(abs(rows["x"][p] - q) < 400 for p, q in (("p25", 5000), ("p50", 10_000), ("p75", 15_000)))
    assert rows["n"]["count"] == 0 and rows["n"].p50 is None and rows["n"].mean is None
    assert {r.column_name for r in profile.profile_describe(df).collect()} == {"x", "s", "n"}


def test_sorted_queries_are_in_order(spark, sf_dir):
    names = [r.c_name for r in core.sort_basic(spark, sf_dir).collect()]
    assert names == sorted(names, reverse=True)
    rows = [(r.o_orderstatus, -r.o_totalprice) for r in core.sort_multi(spark, sf_dir).collect()]
    assert rows == sorted(rows)
    lines = sorted((r.l_discount, r.l_orderkey, r.l_linenumber) for r in inputs.table(spark, sf_dir, "lineitem").collect())
    assert [(r.l_orderkey, r.l_linenumber) for r in core.sort_hidden(spark, sf_dir).collect()] == [x[1:] for x in lines]
    assert [r.day_name for r in queries()["gold_running_days"](spark, sf_dir).collect()] == list(trains.RUNNING_DAYS)


def test_rows_with_one_hash_collapse_to_one(spark):
    df = with_row_hash(spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "id int, v string"), ["v"])
    assert dedup_hash(df).count() == 2 and dedup_hash(df, whole_row=True).count() == 3


def test_a_strict_table_write_refuses_other_columns(spark):
    schema = f"strict_{abs(hash(scratch_path(spark, 's'))) % 10**8}"
    sinks.ensure_schemas(spark, [schema], location_root=scratch_path(spark, "strict"))
    spec = sinks.SinkSpec(f"{schema}.t", "table", keep_schema=True)
    sinks.write_target(spark.range(3), spec)
    with pytest.raises(ValueError, match="columns"):
        sinks.write_target(spark.range(3).select(F.col("id").cast("string")), spec)
    assert spark.table(spec.target).count() == 3
    sinks.write_target(spark.range(5), spec)
    assert spark.table(spec.target).count() == 5


def test_percentages_and_reports_start_no_job_before_an_action(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, v int")
    spark.sparkContext.setJobGroup("lazy", "lazy")
    g = gold.with_pct_of_total(gold.group_summary(df, ["k"], [gold.Measure("n", "count")]), "n")
    report = quality.layer_report([("x", "t", df), ("x", "known", 7), ("x", "missing", None)], baseline=("x", "t"))
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("lazy")
    spark.sparkContext.setJobGroup("", "")
    assert {r.k: r.pct_of_total for r in g.collect()} == {"a": 66.67, "b": 33.33}
    assert {r.table_name: (r.row_count, r.removed_rows) for r in report.collect()} == {"t": (3, 0), "known": (7, -4), "missing": (None, None)}


def test_the_trips_flow_writes_its_quality_tables(spark, sf_dir):
    raw, layout = inputs.trips_raw(spark, sf_dir), LayerLayout(scratch_path(spark, "trips-quality"))
    path = scratch_path(spark, "trips-quality-csv")
    raw.write.option("header", "true").csv(path)
    report = {(r.layer, r.table_name): r.row_count for r in trips.run(spark, path, layout).collect()}
    assert report["source", "trips"] == report["bronze", "trips"] == report["silver", "trips"] + report["quarantine", "trips"] == raw.count()
    results = {r.rule_name: r.failed_rows for r in sinks.read_target(spark, layout.spec("quality", "rule_results")).collect()}
    assert results == {r.rule_name: r.failed_rows for r in quality.run_rules(raw, trips.dq_rules()).collect()} and len(results) == 19
    assert sinks.read_target(spark, layout.spec("quality", "score")).count() == 1


def test_no_scratch_on_a_cluster_without_a_shared_folder():
    from types import SimpleNamespace

    from strata.session import checkpoint_root

    empty = SimpleNamespace(get=lambda *a: None)
    context = SimpleNamespace(getCheckpointDir=lambda: None, getConf=lambda: empty, master="yarn")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_root(SimpleNamespace(sparkContext=context, conf=empty))
