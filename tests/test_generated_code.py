"""Plans compute each expression once, in generated methods that the JVM compiles (below 8,000 bytes)."""

import re

import pytest
from pyspark.sql import functions as F

from strata.operators.bronze import computed_once
from strata.plans import inputs, trains
from strata.queries import queries

#: Fixed value: bytes above which the JVM leaves a method interpreted.
HUGE_METHOD = 8000


def _largest_method(spark, df) -> int:
    codegen = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
    return max([0, *map(int, re.findall(r"maxMethodCodeSize:(\d+)", df._jdf.queryExecution().explainString(codegen)))])


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("key", ["flatten_nested", "flatten_nested_outer", "silver_stops", "gold_route_summary", "gold_station_frequency", "gold_running_days",
                                 "silver_patients", "silver_patients_roles", "silver_places", "silver_trips"])
def test_methods_stay_compilable(spark, sf_dir, key):
    assert _largest_method(spark, queries()[key](spark, sf_dir)) < HUGE_METHOD


def test_trains_silver_tries_each_pattern_once(spark, sf_dir):
    plan = _plan(trains.split_stops(trains.silver_stops(trains.bronze_stops(inputs.trains_raw(spark, sf_dir))))[0])
    patterns = re.findall(r"regexp_extract\([^\n]*?, (\^\(\.\+\?\) -|- \(\.\+\)\$|\^\(\.\+\?\) to | to \(\.\+\)\$|\(\\d\+\)), 1", plan)
    assert len(patterns) >= 5 and "size(" not in plan
    assert plan.count("HALT ") == 1  # the first stop of a record is built in one place


def test_filters_stay_above_what_is_computed_once(spark):
    df = computed_once(spark.range(10).select(F.sha2(F.col("id").cast("string"), 256).alias("h"), "id")).where("h > '5'")
    plan = _plan(df)
    assert plan.count("sha2(") == 1
    assert sorted(r.id for r in df.collect()) == sorted(r.id for r in spark.range(10).where("sha2(cast(id as string), 256) > '5'").collect())
