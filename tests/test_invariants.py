"""Invariants from the test strategy, including property tests on random frames."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.functions.derive import row_hash
from strata.operators import dedup, gold, quality
from strata.plans import inputs, places, trains
from strata.plans.layout import LayerLayout
from strata.session import scratch_path
from strata.sources import sinks

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
maybe_float = st.one_of(st.none(), st.floats(min_value=-1000, max_value=1000, allow_nan=False))


@SETTINGS
@given(st.lists(st.tuples(maybe_float, maybe_float), min_size=0, max_size=30))
def test_split_is_a_partition_of_the_input(spark, rows):
    df = spark.createDataFrame(rows, "a double, b double")
    conds = [F.col("a") < 0, F.col("b") > 500]
    clean, bad = quality.quarantine_split(df, conds)
    assert sorted(map(repr, clean.collect() + bad.collect())) == sorted(map(repr, df.collect()))
    r = quality.reconcile(df, conds).first()
    assert r.balanced and r.input_rows == len(rows)


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), st.text(alphabet="ab|\\N", max_size=3)),
                          st.one_of(st.none(), st.text(alphabet="ab|\\N", max_size=3))), min_size=1, max_size=25))
def test_row_hash_equal_iff_rows_equal(spark, rows):
    df = spark.createDataFrame(rows, "x string, y string")
    out = df.select("x", "y", row_hash(["x", "y"]).alias("h")).collect()
    for r1 in out:
        for r2 in out:
            assert (r1.h == r2.h) == ((r1.x, r1.y) == (r2.x, r2.y))


def test_pct_of_total_sums_to_100_without_filter(spark, sf_dir):
    silver, _ = places.split_places(places.silver_places(places.bronze_places(inputs.places_raw(spark, sf_dir))))
    total = sum(r.pct_of_total for r in places.gold_country_summary(silver).collect())
    assert abs(total - 100.0) < 0.05


def test_dedup_unique_keys_and_idempotent(spark, sf_dir):
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    keys = ["l_orderkey", "l_linenumber"]
    order = [F.col("l_extendedprice").desc(), F.col("l_partkey"), F.col("l_suppkey"), F.col("l_shipdate")]
    once = dedup.dedup_top1(li, keys, order)
    assert once.count() == li.select(*keys).distinct().count()
    twice = dedup.dedup_top1(once, keys, order)
    assert twice.exceptAll(once).count() == 0 and once.exceptAll(twice).count() == 0


def test_unpivot_row_count(spark, sf_dir):
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    cols = ["l_quantity", "l_discount", "l_tax"]
    assert li.unpivot(["l_orderkey"], cols, "name", "v").count() == li.count() * len(cols)


def test_rule_counts_equal_filters(spark, sf_dir):
    from strata.plans import trips
    raw = inputs.trips_raw(spark, sf_dir)
    got = {r.rule_name: r.failed_rows for r in quality.run_rules(raw, trips.dq_rules()).collect()}
    for rule in trips.dq_rules():
        assert got[rule.name] == raw.filter(rule.bad).count()


def test_trains_flow_rerun_is_stable(spark, sf_dir):
    landing = scratch_path(spark, "test-trains-landing")
    sinks.write_json_documents(inputs.trains_raw(spark, sf_dir), landing, records_per_file=300)
    layout = LayerLayout(scratch_path(spark, "test-trains-layers"))
    first = sorted(trains.run(spark, landing, layout).collect())
    gold_first = spark.read.parquet(layout.spec("gold", "route_summary").target).collect()
    second = sorted(trains.run(spark, landing, layout).collect())           # overwrite: same content
    gold_second = spark.read.parquet(layout.spec("gold", "route_summary").target).collect()
    assert first == second and sorted(gold_first) == sorted(gold_second)
    report = {(r.layer, r.table_name): r.row_count for r in first}
    assert report[("silver", "stops")] + report[("quarantine", "stops")] == report[("bronze", "stops")]
    assert report[("gold", "running_days")] == 7
    by_hand = gold.group_summary(spark.read.parquet(trains.layer_locations(layout)["silver"]), ["trainNumber"],
                                 [gold.Measure("n", "count")]).count()
    assert report[("gold", "route_summary")] == by_hand
