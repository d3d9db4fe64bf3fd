"""Taxi trips: data-quality gate → bronze + quarantine → enriched silver → 3 gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.casts import flag
from strata.functions.derive import guarded_rate, minutes_between
from strata.operators.bronze import audit_columns, business_columns
from strata.operators.gold import Measure, group_summary, stacked_group_summary, union_tagged
from strata.operators.quality import (
    Rule, dq_by_category, dq_score, layer_report, null_profile, quarantine_reason, quarantine_split, run_rules,
)
from strata.plans.layout import LayerLayout
from strata.sources.readers import read_csv, read_layer
from strata.sources.sinks import write_all, write_counted

PICKUP, DROPOFF = "lpep_pickup_datetime", "lpep_dropoff_datetime"


# Rule names, categories, allowed codes and thresholds of the 19 checks
# (5 completeness, 5 domain, 7 range, 2 temporal); the condition holds for a violation.
RULES = [
    ("NULL_vendor_id", "completeness", "VendorID IS NULL"),
    ("NULL_pickup_datetime", "completeness", "lpep_pickup_datetime IS NULL"),
    ("NULL_dropoff_datetime", "completeness", "lpep_dropoff_datetime IS NULL"),
    ("NULL_passenger_count", "completeness", "passenger_count IS NULL"),
    ("NULL_fare_amount", "completeness", "fare_amount IS NULL"),
    ("INVALID_vendor_id", "domain", "VendorID NOT IN (1, 2) AND VendorID IS NOT NULL"),
    ("INVALID_ratecode_id", "domain", "RatecodeID NOT IN (1, 2, 3, 4, 5, 6, 99) AND RatecodeID IS NOT NULL"),
    ("INVALID_payment_type", "domain", "payment_type NOT IN (1, 2, 3, 4, 5, 6) AND payment_type IS NOT NULL"),
    ("INVALID_trip_type", "domain", "trip_type NOT IN (1, 2) AND trip_type IS NOT NULL"),
    ("INVALID_store_fwd", "domain", "store_and_fwd_flag NOT IN ('Y', 'N') AND store_and_fwd_flag IS NOT NULL"),
    ("NEGATIVE_fare", "range", "fare_amount < 0"),
    ("NEGATIVE_tip", "range", "tip_amount < 0"),
    ("NEGATIVE_total", "range", "total_amount < 0"),
    ("ZERO_trip_distance", "range", "trip_distance = 0"),
    ("EXTREME_distance", "range", "trip_distance > 200"),
    ("EXTREME_fare", "range", "fare_amount > 500"),
    ("EXTREME_passengers", "range", "passenger_count > 6"),
    ("DROPOFF_before_pickup", "temporal", "lpep_dropoff_datetime < lpep_pickup_datetime"),
    ("ZERO_duration_trip", "temporal", "lpep_dropoff_datetime = lpep_pickup_datetime"),
]
# Violations that send a trip to quarantine.
CRITICAL = ("NEGATIVE_fare", "NEGATIVE_total", "EXTREME_distance", "DROPOFF_before_pickup")
# Columns of the raw file.
RAW_SCHEMA = (
    "VendorID int, lpep_pickup_datetime timestamp_ntz, lpep_dropoff_datetime timestamp_ntz, store_and_fwd_flag string, "
    "RatecodeID int, PULocationID int, DOLocationID int, passenger_count int, trip_distance double, fare_amount double, "
    "tip_amount double, total_amount double, payment_type int, trip_type int, congestion_surcharge double, ehail_fee double"
)


def dq_rules() -> list[Rule]:
    """The 19 checks as expressions (``bad`` = violation)."""
    return [Rule(name, category, F.expr(condition)) for name, category, condition in RULES]


def critical_rules() -> list[Rule]:
    return [r for r in dq_rules() if r.name in CRITICAL]


def split_trips(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    return quarantine_split(raw, [r.bad for r in critical_rules()])


def bronze_trips(raw: DataFrame, source_file: str, batch_id: int = 1) -> DataFrame:
    return audit_columns(raw, literals={"_source_file": source_file, "_batch_id": batch_id})


def quarantine_trips(raw: DataFrame) -> DataFrame:
    return audit_columns(quarantine_reason(raw, critical_rules()))


# Null replacements applied after the derivations.
FILL_VALUES = {"passenger_count": 1, "congestion_surcharge": 0.0, "RatecodeID": 1}
LONG_TRIP_MILES = 10


def silver_trips(clean: DataFrame) -> DataFrame:
    """Drop the empty fee column, derive duration/speed/long-trip/date/hour, fill nulls, audit."""
    duration = minutes_between(PICKUP, DROPOFF)
    df = clean.drop("ehail_fee").withColumns({
        "trip_duration_minutes": duration,
        "speed_mph": guarded_rate(F.col("trip_distance"), duration),
        "is_long_trip": flag(F.col("trip_distance") > LONG_TRIP_MILES),
        "pickup_date": F.to_date(PICKUP),
        "pickup_hour": F.hour(PICKUP),
    })
    return df.fillna(FILL_VALUES).withColumn("_processed_at", F.current_timestamp())


def _avg2(name: str, col: str, exact: bool) -> Measure:
    return Measure(name, "avg", col, round=2, exact=exact)


def gold_daily(silver: DataFrame, exact: bool = False) -> DataFrame:
    return group_summary(silver, ["pickup_date"], [
        Measure("total_trips", "count"),
        Measure("total_revenue", "sum", "total_amount", exact=True),
        _avg2("avg_fare", "fare_amount", exact), _avg2("avg_distance", "trip_distance", exact),
        _avg2("avg_duration_min", "trip_duration_minutes", exact), _avg2("avg_tip", "tip_amount", exact),
        Measure("long_trips", "count_if", F.col("is_long_trip")),
        _avg2("avg_speed_mph", "speed_mph", exact), _avg2("avg_passengers", "passenger_count", exact),
    ], order_by=["pickup_date"])


def gold_hourly(silver: DataFrame, exact: bool = False) -> DataFrame:
    return group_summary(silver, ["pickup_hour"], [
        Measure("total_trips", "count"),
        _avg2("avg_fare", "fare_amount", exact), _avg2("avg_distance", "trip_distance", exact),
        _avg2("avg_duration_min", "trip_duration_minutes", exact), _avg2("avg_tip", "tip_amount", exact),
    ], order_by=["pickup_hour"])


def location_measures(exact: bool = False) -> list[Measure]:
    return [Measure("trip_count", "count"),
            Measure("total_revenue", "sum", "total_amount", round=2, exact=True),
            _avg2("avg_fare", "fare_amount", exact)]


def gold_top_locations(silver: DataFrame, exact: bool = False) -> DataFrame:
    """Pickup and dropoff zones in one table, busiest first — one scan, one shuffle."""
    return stacked_group_summary(silver, "location_type", "location_id",
                                 {"pickup": "PULocationID", "dropoff": "DOLocationID"},
                                 location_measures(exact)).orderBy(F.col("trip_count").desc())


def gold_top_locations_union(silver: DataFrame, exact: bool = False) -> DataFrame:
    """The same table as a tagged union of two aggregates (two scans, two shuffles)."""
    ms = location_measures(exact)
    pick = group_summary(silver, [F.col("PULocationID").alias("location_id")], ms)
    drop = group_summary(silver, [F.col("DOLocationID").alias("location_id")], ms)
    return union_tagged({"pickup": pick, "dropoff": drop}, "location_type").orderBy(F.col("trip_count").desc())


def quality_tables(trips: DataFrame) -> dict[str, DataFrame]:
    """Null profile, the 19 rules' results, score and failures by category."""
    results = run_rules(trips, dq_rules())
    return {"null_profile": null_profile(trips), "rule_results": results, "score": dq_score(results),
            "failures_by_category": dq_by_category(results)}


def run(spark: SparkSession, csv_path: str, layout: LayerLayout, schema: str = RAW_SCHEMA) -> DataFrame:
    """CSV → bronze → quality tables, quarantine and silver → gold; returns the layer report.

    The raw file is read once, with its schema; everything after works on the
    written bronze layer.
    """
    source = csv_path.rsplit("/", 1)[-1]
    bronze_spec, quarantine_spec = layout.spec("bronze", "trips"), layout.spec("quarantine", "trips")
    source_rows = write_counted(bronze_trips(read_csv(spark, csv_path, schema=schema), source), bronze_spec)
    bronze = read_layer(spark, bronze_spec.target, layout.format)
    trips = bronze.select(business_columns(bronze))
    write_all(spark, {name: (df, layout.spec("quality", name)) for name, df in quality_tables(trips).items()})
    clean, _ = split_trips(trips)
    write_counted(quarantine_trips(trips), quarantine_spec)
    silver_spec = layout.spec("silver", "trips")
    write_counted(silver_trips(clean), silver_spec)
    silver = read_layer(spark, silver_spec.target, layout.format)
    gold = {
        "daily": (gold_daily(silver), layout.spec("gold", "daily")),
        "hourly": (gold_hourly(silver), layout.spec("gold", "hourly")),
        "top_locations": (gold_top_locations(silver), layout.spec("gold", "top_locations")),
    }
    write_all(spark, gold)
    entries = [("source", "trips", source_rows), ("bronze", "trips", bronze),
               ("quarantine", "trips", read_layer(spark, quarantine_spec.target, layout.format)),
               ("silver", "trips", silver)]
    entries += [("gold", n, read_layer(spark, s.target, layout.format)) for n, (_, s) in gold.items()]
    return layer_report(entries, baseline=("source", "trips"))
