"""Checks of the generic operators on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.casts import null_if_equal, safe_cast
from strata.functions.derive import bucketize, guarded_rate, minutes_between, row_hash as hash_expr, safe_ratio, \
    stay_days
from strata.functions.text import digits_and_plus, leading_number, proper_case, split_labelled, split_route
from strata.operators import bronze, clean, dedup, gold, profile, quality
from strata.plans import inputs, places, trips
from strata.queries import register
from strata.queries.sqlhelp import (
    PLACES_RAW, TRIPS_RAW, avg_rounded, cols, initcap, pct, row_hash, sum_rounded,
)


def T(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return inputs.table(spark, sf, name)


# ------------------------------------------------------------------ projections

@register("project_select", "SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem")
def project_select(spark, sf):
    return T(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")


@register("project_alias", "SELECT c_custkey AS customer_id, c_name AS customer_name, c_nationkey AS nation_id "
                           "FROM customer")
def project_alias(spark, sf):
    c = T(spark, sf, "customer")
    return c.select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"),
                    "c_nationkey").withColumnRenamed("c_nationkey", "nation_id")


@register("rename_map", "SELECT c_custkey AS customer_id, c_name AS customer_name, c_nationkey, c_acctbal AS balance, "
                        "c_mktsegment AS segment FROM customer")
def rename_map(spark, sf):
    return bronze.rename_map(T(spark, sf, "customer"), {
        "c_custkey": "customer_id", "c_name": "customer_name", "c_acctbal": "balance",
        "c_mktsegment": "segment", "c_not_there": "ignored"})


@register("drop_columns", "SELECT p_partkey, p_name, p_brand, p_retailprice FROM part")
def drop_columns(spark, sf):
    return bronze.drop_columns(T(spark, sf, "part"), ["p_type", "p_size", "p_not_there"])


@register("derive_columns", """SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS disc_price,
  l_extendedprice * (1 - l_discount) * (1 + l_tax) AS charge, cast(year(l_shipdate) AS INTEGER) AS ship_year,
  l_quantity > 25 AS is_bulk FROM lineitem""")
def derive_columns(spark, sf):
    li = T(spark, sf, "lineitem")
    disc = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return li.withColumns({"disc_price": disc, "charge": disc * (1 + F.col("l_tax")),
                           "ship_year": F.year("l_shipdate"), "is_bulk": F.col("l_quantity") > 25}) \
        .select("l_orderkey", "l_linenumber", "disc_price", "charge", "ship_year", "is_bulk")


@register("audit_columns", "SELECT *, 'supplier.parquet' AS _source_file, 1 AS _batch_id, true AS has_ingest_time "
                           "FROM supplier")
def audit_columns(spark, sf):
    df = bronze.audit_columns(T(spark, sf, "supplier"), literals={"_source_file": "supplier.parquet", "_batch_id": 1})
    return df.withColumn("has_ingest_time", F.col("_ingested_at").isNotNull()).drop("_ingested_at")


_HASH_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]


@register("row_hash", f"SELECT o_orderkey, {row_hash(_HASH_COLS)} AS row_hash FROM orders")
def row_hash_key(spark, sf):
    return T(spark, sf, "orders").select("o_orderkey", hash_expr(_HASH_COLS).alias("row_hash"))


@register("surrogate_id", "SELECT count(*) AS row_count, count(*) AS distinct_ids FROM orders")
def surrogate_id(spark, sf):
    df = bronze.surrogate_id(T(spark, sf, "orders"), "_record_id")
    return df.agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct("_record_id").alias("distinct_ids"))


_PADDED_PART = ("SELECT p_partkey, concat('  ', p_name, ' ') AS p_name, concat(' ', p_brand) AS p_brand, "
                "concat(p_type, '  ') AS p_type, p_size FROM part")


@register("trim_all_strings", f"SELECT p_partkey, trim(p_name) AS p_name, trim(p_brand) AS p_brand, "
                              f"trim(p_type) AS p_type, p_size FROM ({_PADDED_PART})")
def trim_all_strings(spark, sf):
    padded = T(spark, sf, "part").selectExpr(
        "p_partkey", "concat('  ', p_name, ' ') AS p_name", "concat(' ', p_brand) AS p_brand",
        "concat(p_type, '  ') AS p_type", "p_size")
    return clean.trim_all_strings(padded)


@register("str_trim_case", """SELECT c_custkey, trim(concat('  ', c_name, ' ')) AS name_trimmed,
  upper(lower(c_mktsegment)) AS segment_upper, lower(c_mktsegment) AS segment_lower FROM customer""")
def str_trim_case(spark, sf):
    c = T(spark, sf, "customer")
    return c.select("c_custkey", F.trim(F.concat(F.lit("  "), "c_name", F.lit(" "))).alias("name_trimmed"),
                    F.upper(F.lower("c_mktsegment")).alias("segment_upper"),
                    F.lower("c_mktsegment").alias("segment_lower"))


@register("str_initcap", f"SELECT p_partkey, {initcap('trim(upper(p_name))')} AS name_proper, "
                         f"{initcap('lower(p_type)')} AS type_proper FROM part")
def str_initcap(spark, sf):
    p = T(spark, sf, "part")
    return p.select("p_partkey", proper_case(F.upper("p_name")).alias("name_proper"),
                    F.initcap(F.lower("p_type")).alias("type_proper"))


_ROLE_INPUT = ("SELECT c_custkey AS customer_id, concat(' ', lower(c_name)) AS customer_name, "
               "lower(c_mktsegment) AS segment_type, cast(c_acctbal AS string) AS balance_amount, "
               "cast(c_nationkey AS string) AS nation_age, cast(o_orderdate AS string) AS order_date "
               "FROM customer JOIN orders ON o_custkey = c_custkey")


@register("role_transform", f"""SELECT customer_id, {initcap('trim(customer_name)')} AS customer_name,
  upper(trim(segment_type)) AS segment_type, TRY_CAST(trim(balance_amount) AS DOUBLE) AS balance_amount,
  TRY_CAST(trim(nation_age) AS INTEGER) AS nation_age, TRY_CAST(trim(order_date) AS DATE) AS order_date
FROM ({_ROLE_INPUT})""")
def role_transform(spark, sf):
    c, o = T(spark, sf, "customer"), T(spark, sf, "orders")
    df = c.join(o, o.o_custkey == c.c_custkey).select(
        F.col("c_custkey").alias("customer_id"),
        F.concat(F.lit(" "), F.lower("c_name")).alias("customer_name"),
        F.lower("c_mktsegment").alias("segment_type"),
        F.col("c_acctbal").cast("string").alias("balance_amount"),
        F.col("c_nationkey").cast("string").alias("nation_age"),
        F.col("o_orderdate").cast("string").alias("order_date"))
    roles = clean.resolve_roles(df, [
        clean.RoleRule("trim", ("name", "type", "amount", "age", "date"), ("string",)),
        clean.RoleRule("proper", ("name",), ("string",)),
        clean.RoleRule("upper", ("type",), ("string",)),
        clean.RoleRule("date", ("date",)),
        clean.RoleRule("double", ("amount",)),
        clean.RoleRule("int", ("age",)),
    ])
    return clean.role_transform(df, roles, ["trim", "proper", "upper", "date", "double", "int"])


@register("str_regexp_extract", """SELECT p_partkey,
  trim(regexp_extract(concat(p_name, ' - ', p_brand), '^(.+?) -', 1)) AS station_name,
  trim(regexp_extract(concat(p_name, ' - ', p_brand), '- (.+)$', 1)) AS station_code,
  trim(regexp_extract(concat(p_type, ' to ', p_brand), '^(.+?) to ', 1)) AS origin,
  trim(regexp_extract(concat(p_type, ' to ', p_brand), ' to (.+)$', 1)) AS destination,
  trim(regexp_extract(p_name, '^(.+?) -', 1)) AS unlabelled FROM part""")
def str_regexp_extract(spark, sf):
    p = T(spark, sf, "part")
    name, code = split_labelled(F.concat("p_name", F.lit(" - "), "p_brand"))
    origin, dest = split_route(F.concat("p_type", F.lit(" to "), "p_brand"))
    return p.select("p_partkey", name.alias("station_name"), code.alias("station_code"), origin.alias("origin"),
                    dest.alias("destination"), split_labelled(F.col("p_name"))[0].alias("unlabelled"))


@register("str_regexp_replace", """SELECT p_partkey, regexp_replace(concat('+1 (', cast(p_size AS string), ') ',
  p_brand, '-', cast(p_partkey AS string)), '[^\\d+]', '', 'g') AS phone_clean FROM part""")
def str_regexp_replace(spark, sf):
    p = T(spark, sf, "part")
    raw = F.concat(F.lit("+1 ("), F.col("p_size").cast("string"), F.lit(") "), "p_brand", F.lit("-"),
                   F.col("p_partkey").cast("string"))
    return p.select("p_partkey", digits_and_plus(raw).alias("phone_clean"))


_DIST = ("CASE WHEN p_partkey % 7 = 0 THEN 'n/a' WHEN p_partkey % 5 = 0 THEN concat(cast(p_size AS string), ',500 kms') "
         "ELSE concat(cast(p_size AS string), ' kms') END")


@register("safe_cast", f"""SELECT p_partkey,
  TRY_CAST(concat(cast(p_size AS string), CASE WHEN p_partkey % 3 = 0 THEN 'x' ELSE '' END) AS INTEGER) AS size_int,
  TRY_CAST(CASE WHEN p_partkey % 4 = 0 THEN '' ELSE cast(p_retailprice AS string) END AS DOUBLE) AS price,
  TRY_CAST(regexp_extract({_DIST}, '(\\d+)', 1) AS DOUBLE) AS distance_km,
  TRY_CAST(regexp_extract(replace({_DIST}, ',', ''), '(\\d+(?:\\.\\d+)?)', 1) AS DOUBLE) AS distance_full
FROM part""")
def safe_cast_key(spark, sf):
    p = T(spark, sf, "part")
    dist = F.expr(_DIST)
    return p.select(
        "p_partkey",
        safe_cast(F.concat(F.col("p_size").cast("string"),
                           F.when(F.col("p_partkey") % 3 == 0, F.lit("x")).otherwise(F.lit(""))), "int").alias("size_int"),
        safe_cast(F.when(F.col("p_partkey") % 4 == 0, F.lit("")).otherwise(F.col("p_retailprice").cast("string")),
                  "double").alias("price"),
        leading_number(dist).alias("distance_km"),
        leading_number(dist, "full").alias("distance_full"))


_STOPS = "SELECT l_orderkey, l_linenumber, " + cols(inputs.STOP_COLUMNS) + " FROM lineitem"


@register("null_sentinel", f"""SELECT l_orderkey, l_linenumber, nullif(arrives, 'Source') AS arrival_time,
  nullif(departs, 'Destination') AS departure_time, arrives = 'Source' AS is_source,
  departs = 'Destination' AS is_destination FROM ({_STOPS})""")
def null_sentinel(spark, sf):
    stops = T(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", *[F.expr(e).alias(n) for n, e in inputs.STOP_COLUMNS.items()])
    return stops.select("l_orderkey", "l_linenumber", null_if_equal("arrives", "Source").alias("arrival_time"),
                        null_if_equal("departs", "Destination").alias("departure_time"),
                        (F.col("arrives") == "Source").alias("is_source"),
                        (F.col("departs") == "Destination").alias("is_destination"))


@register("flag_completeness", f"""SELECT point_of_interest,
  coalesce(trim(address) IS NOT NULL AND length(trim(address)) > 0, false) AS has_address,
  coalesce(trim(phone) IS NOT NULL OR trim(url) IS NOT NULL, false) AS has_contact,
  coalesce(length(trim(phone)) > 0 OR length(trim(url)) > 0, false) AS has_contact_strict
FROM ({PLACES_RAW})""")
def flag_completeness(spark, sf):
    raw = inputs.places_raw(spark, sf)
    silver = places.silver_places(places.bronze_places(raw))
    return silver.select("point_of_interest", "has_address", "has_contact",
                         places.has_contact(strict=True).alias("has_contact_strict"))


@register("fill_nulls", f"""SELECT lpep_pickup_datetime, lpep_dropoff_datetime, coalesce(passenger_count, 1) AS passenger_count,
  coalesce(congestion_surcharge, 0.0) AS congestion_surcharge, coalesce(RatecodeID, 1) AS RatecodeID
FROM ({TRIPS_RAW})""")
def fill_nulls(spark, sf):
    return inputs.trips_raw(spark, sf).fillna(trips.FILL_VALUES).select(
        "lpep_pickup_datetime", "lpep_dropoff_datetime", "passenger_count", "congestion_surcharge", "RatecodeID")


@register("bucketize", """SELECT c_custkey,
  CASE WHEN 18 + c_custkey % 68 < 18 THEN 'Pediatric' WHEN 18 + c_custkey % 68 < 40 THEN 'Young Adult'
       WHEN 18 + c_custkey % 68 < 60 THEN 'Middle Aged' ELSE 'Senior' END AS age_group,
  CASE WHEN c_acctbal < 0 THEN 'Negative' WHEN c_acctbal < 1000 THEN 'Low' WHEN c_acctbal < 5000 THEN 'Medium'
       ELSE 'High' END AS balance_band,
  CASE WHEN c_custkey % 9 = 0 THEN 'Unknown' WHEN c_acctbal < 0 THEN 'Negative' ELSE 'Positive' END AS sign_band
FROM customer""")
def bucketize_key(spark, sf):
    c = T(spark, sf, "customer")
    age = F.lit(18) + F.col("c_custkey") % 68
    bal_or_null = F.when(F.col("c_custkey") % 9 != 0, F.col("c_acctbal"))
    return c.select(
        "c_custkey",
        bucketize(age, [(18, "Pediatric"), (40, "Young Adult"), (60, "Middle Aged")], "Senior").alias("age_group"),
        bucketize("c_acctbal", [(0, "Negative"), (1000, "Low"), (5000, "Medium")], "High").alias("balance_band"),
        bucketize(bal_or_null, [(0, "Negative")], "Positive", null_label="Unknown").alias("sign_band"))


@register("date_parts", "SELECT event_id, cast(ts AS DATE) AS event_date, cast(hour(ts) AS INTEGER) AS event_hour "
                        "FROM events")
def date_parts(spark, sf):
    e = T(spark, sf, "events")
    return e.select("event_id", F.to_date("ts").alias("event_date"), F.hour("ts").alias("event_hour"))


@register("length_of_stay", """SELECT l_orderkey, l_linenumber,
  cast(datediff('day', cast(o_orderdate AS DATE), cast(l_shipdate AS DATE)) AS INTEGER) AS stay_days
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def length_of_stay(spark, sf):
    li, o = T(spark, sf, "lineitem"), T(spark, sf, "orders")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        "l_orderkey", "l_linenumber", stay_days(F.to_date("l_shipdate"), F.to_date("o_orderdate")).alias("stay_days"))


_DURATION = "round(datediff('second', lpep_pickup_datetime, lpep_dropoff_datetime) / 60, 2)"


@register("trip_duration", f"SELECT lpep_pickup_datetime, lpep_dropoff_datetime, {_DURATION} AS trip_duration_minutes "
                           f"FROM ({TRIPS_RAW})")
def trip_duration(spark, sf):
    return inputs.trips_raw(spark, sf).select(
        "lpep_pickup_datetime", "lpep_dropoff_datetime",
        minutes_between("lpep_pickup_datetime", "lpep_dropoff_datetime").alias("trip_duration_minutes"))


@register("trip_speed", f"""SELECT lpep_pickup_datetime, trip_distance,
  round(CASE WHEN {_DURATION} > 0 AND trip_distance > 0 THEN trip_distance / ({_DURATION} / 60) END, 2) AS speed_mph
FROM ({TRIPS_RAW})""")
def trip_speed(spark, sf):
    raw = inputs.trips_raw(spark, sf)
    dur = minutes_between("lpep_pickup_datetime", "lpep_dropoff_datetime")
    return raw.select("lpep_pickup_datetime", "trip_distance", guarded_rate("trip_distance", dur).alias("speed_mph"))


@register("math_round", """SELECT l_orderkey, l_linenumber, round(l_quantity / 3, 1) AS qty_third,
  round(l_quantity / 7, 2) AS qty_seventh, round(l_quantity / 9, 4) AS qty_ninth, round(l_quantity / 11, 6) AS qty_eleventh,
  cast(round(cast(l_extendedprice AS DECIMAL(20,2)), 1) AS DOUBLE) AS price_1dp FROM lineitem""")
def math_round(spark, sf):
    li = T(spark, sf, "lineitem")
    q = F.col("l_quantity")
    return li.select("l_orderkey", "l_linenumber", F.round(q / 3, 1).alias("qty_third"),
                     F.round(q / 7, 2).alias("qty_seventh"), F.round(q / 9, 4).alias("qty_ninth"),
                     F.round(q / 11, 6).alias("qty_eleventh"),
                     F.round(F.col("l_extendedprice").cast("decimal(20,2)"), 1).cast("double").alias("price_1dp"))


# ------------------------------------------------------------------ filters

@register("filter_conjunction", "SELECT * FROM lineitem WHERE l_quantity >= 40 AND l_discount < 0.03")
def filter_conjunction(spark, sf):
    li = T(spark, sf, "lineitem")
    return li.filter((F.col("l_quantity") >= 40) & (F.col("l_discount") < 0.03))


@register("filter_not_blank", f"SELECT * FROM ({PLACES_RAW}) WHERE city IS NOT NULL AND trim(city) <> '' "
                              f"AND categories IS NOT NULL AND categories <> ''")
def filter_not_blank(spark, sf):
    raw = inputs.places_raw(spark, sf)
    return raw.filter(places.not_blank("categories") & F.col("city").isNotNull() & (F.trim("city") != ""))


@register("filter_range", f"""SELECT point_of_interest, TRY_CAST(latitude AS DOUBLE) AS lat, TRY_CAST(longitude AS DOUBLE) AS lon
FROM ({PLACES_RAW}) WHERE TRY_CAST(latitude AS DOUBLE) BETWEEN -90 AND 90 AND TRY_CAST(longitude AS DOUBLE) BETWEEN -180 AND 180""")
def filter_range(spark, sf):
    raw = inputs.places_raw(spark, sf).select(
        "point_of_interest", safe_cast("latitude", "double").alias("lat"), safe_cast("longitude", "double").alias("lon"))
    return raw.filter(F.col("lat").between(-90, 90) & F.col("lon").between(-180, 180))


@register("filter_domain", f"SELECT * FROM ({TRIPS_RAW}) WHERE VendorID NOT IN (1, 2) AND VendorID IS NOT NULL")
def filter_domain(spark, sf):
    return inputs.trips_raw(spark, sf).filter(~F.col("VendorID").isin(1, 2) & F.col("VendorID").isNotNull())


@register("filter_temporal", f"SELECT * FROM ({TRIPS_RAW}) WHERE lpep_dropoff_datetime < lpep_pickup_datetime")
def filter_temporal(spark, sf):
    return inputs.trips_raw(spark, sf).filter(F.col("lpep_dropoff_datetime") < F.col("lpep_pickup_datetime"))


@register("filter_non_negative", "SELECT * FROM customer WHERE c_acctbal >= 0")
def filter_non_negative(spark, sf):
    from strata.plans.patients import filter_non_negative as keep_non_negative
    return keep_non_negative(T(spark, sf, "customer"), "c_acctbal")


@register("non_negative_report", """SELECT count(*) AS input_rows, cast(count_if(c_acctbal >= 0) AS BIGINT) AS kept_rows,
  cast(count_if(c_acctbal < 0) AS BIGINT) AS negative_rows, cast(count_if(c_acctbal IS NULL) AS BIGINT) AS null_rows
FROM (SELECT CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_acctbal END AS c_acctbal, c_custkey FROM customer)""")
def non_negative_report(spark, sf):
    from strata.plans.patients import non_negative_report as report
    c = T(spark, sf, "customer").withColumn(
        "c_acctbal", F.when(F.col("c_custkey") % 13 != 0, F.col("c_acctbal")))
    return report(c, "c_acctbal")


# ------------------------------------------------------------------ data quality (trips rules)

DQ_RESULTS_SQL = f"""WITH raw AS ({TRIPS_RAW}),
counts AS ({" UNION ALL ".join(
    f"SELECT '{r}' AS rule_name, '{c}' AS category, cast(count_if({cond}) AS BIGINT) AS failed_rows, "
    f"count(*) AS total FROM raw" for r, c, cond in trips.RULES)}),
results AS (SELECT rule_name, category, failed_rows,
  round(cast(failed_rows AS double) / cast(total AS double) * 100, 2) AS fail_pct,
  CASE WHEN failed_rows = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM counts)"""


def _dq_results(spark, sf):
    return quality.run_rules(inputs.trips_raw(spark, sf), trips.dq_rules())


@register("dq_rules", f"{DQ_RESULTS_SQL} SELECT * FROM results")
def dq_rules(spark, sf):
    return _dq_results(spark, sf)


@register("dq_score", f"""{DQ_RESULTS_SQL} SELECT count(*) AS rules_evaluated,
  cast(count_if(status = 'PASS') AS BIGINT) AS rules_passed, cast(count_if(status = 'FAIL') AS BIGINT) AS rules_failed,
  round(cast(count_if(status = 'PASS') AS double) / cast(count(*) AS double) * 100, 1) AS dq_score FROM results""")
def dq_score(spark, sf):
    return quality.dq_score(_dq_results(spark, sf))


@register("dq_by_category", f"""{DQ_RESULTS_SQL} SELECT category, count(*) AS failed_rules,
  cast(sum(failed_rows) AS BIGINT) AS total_failed_rows FROM results WHERE status = 'FAIL' GROUP BY category""")
def dq_by_category(spark, sf):
    return quality.dq_by_category(_dq_results(spark, sf))


_TRIPS_BAD = ("coalesce(fare_amount < 0 OR total_amount < 0 OR trip_distance > 200 "
              "OR lpep_dropoff_datetime < lpep_pickup_datetime, false)")


@register("quarantine_split", f"SELECT * FROM ({TRIPS_RAW}) WHERE NOT {_TRIPS_BAD}")
def quarantine_split(spark, sf):
    clean_rows, _ = trips.split_trips(inputs.trips_raw(spark, sf))
    return clean_rows


@register("quarantine_reason", f"""SELECT *, 'DQ_CRITICAL_FAILURE' AS _quarantine_reason,
  concat_ws(',', CASE WHEN fare_amount < 0 THEN 'NEGATIVE_fare' END, CASE WHEN total_amount < 0 THEN 'NEGATIVE_total' END,
    CASE WHEN trip_distance > 200 THEN 'EXTREME_distance' END,
    CASE WHEN lpep_dropoff_datetime < lpep_pickup_datetime THEN 'DROPOFF_before_pickup' END) AS failed_rules
FROM ({TRIPS_RAW}) WHERE {_TRIPS_BAD}""")
def quarantine_reason(spark, sf):
    q = quality.quarantine_reason(inputs.trips_raw(spark, sf), trips.critical_rules())
    return q.withColumn("failed_rules", F.array_join("_failed_rules", ",")).drop("_failed_rules")


@register("reconcile", f"""SELECT count(*) AS input_rows, cast(count_if(NOT {_TRIPS_BAD}) AS BIGINT) AS clean_rows,
  cast(count_if({_TRIPS_BAD}) AS BIGINT) AS quarantine_rows, true AS balanced FROM ({TRIPS_RAW})""")
def reconcile(spark, sf):
    return quality.reconcile(inputs.trips_raw(spark, sf), [r.bad for r in trips.critical_rules()])


@register("reconcile_outputs", f"""SELECT count(*) AS input_rows, cast(count_if(NOT {_TRIPS_BAD}) AS BIGINT) AS clean_rows,
  cast(count_if({_TRIPS_BAD}) AS BIGINT) AS quarantine_rows, true AS balanced FROM ({TRIPS_RAW})""")
def reconcile_outputs(spark, sf):
    raw = inputs.trips_raw(spark, sf)
    good, bad = trips.split_trips(raw)
    return quality.reconcile_outputs(raw, good, bad)


_LI_NULLS = {
    "l_orderkey": "l_orderkey",
    "l_tax": "CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_tax END",
    "l_returnflag": "CASE WHEN l_linenumber = 3 THEN NULL ELSE l_returnflag END",
    "l_shipdate": "CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE l_shipdate END",
    "l_quantity": "l_quantity",
}
_LI_NULLS_SQL = "SELECT " + cols(_LI_NULLS) + " FROM lineitem"


def _li_nulls(spark, sf):
    return T(spark, sf, "lineitem").selectExpr(*[f"{e} AS {k}" for k, e in _LI_NULLS.items()])


@register("null_profile", "SELECT column_name, null_count, total_rows, " + pct("null_count", "total_rows")
          + " AS null_pct FROM (" + " UNION ALL ".join(
              f"SELECT '{c}' AS column_name, cast(count_if({c} IS NULL) AS BIGINT) AS null_count, count(*) AS total_rows "
              f"FROM ({_LI_NULLS_SQL})" for c in _LI_NULLS) + ")")
def null_profile(spark, sf):
    return quality.null_profile(_li_nulls(spark, sf))


@register("null_profile_wide", "SELECT " + ", ".join(f"cast(count_if({c} IS NULL) AS BIGINT) AS {c}" for c in _LI_NULLS)
          + f" FROM ({_LI_NULLS_SQL})")
def null_profile_wide(spark, sf):
    return quality.null_profile_wide(_li_nulls(spark, sf))


# ------------------------------------------------------------------ dedup

_LI_ALL = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
           "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
_LI_TIES = ["l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@register("dedup_top1", f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_extendedprice DESC NULLS LAST, {", ".join(c + " ASC NULLS FIRST" for c in _LI_TIES)}) AS rn FROM lineitem)
WHERE rn = 1""")
def dedup_top1(spark, sf):
    return dedup.dedup_top1(T(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"],
                            [F.col("l_extendedprice").desc_nulls_last()], [F.col(c).asc_nulls_first() for c in _LI_TIES])


_DUP_COLS = ["o_custkey", "o_orderstatus", "o_orderpriority"]


@register("dedup_hash", f"SELECT DISTINCT {', '.join(_DUP_COLS)}, {row_hash(_DUP_COLS)} AS _row_hash FROM orders")
def dedup_hash(spark, sf):
    hashed = bronze.with_row_hash(T(spark, sf, "orders").select(*_DUP_COLS), _DUP_COLS)
    return dedup.dedup_hash(hashed, "_row_hash", whole_row=True)


@register("dedup_hash_only", f"SELECT DISTINCT {', '.join(_DUP_COLS)}, {row_hash(_DUP_COLS)} AS _row_hash FROM orders")
def dedup_hash_only(spark, sf):
    """One row per hash while the other columns differ between the copies; the columns the hash covers are compared."""
    orders = T(spark, sf, "orders")
    return dedup.dedup_hash(bronze.with_row_hash(orders, _DUP_COLS), "_row_hash").select(*_DUP_COLS, "_row_hash")


@register("dedup_key", """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
  ORDER BY o_totalprice DESC NULLS LAST, o_orderkey ASC NULLS FIRST) AS rn FROM orders) WHERE rn = 1""")
def dedup_key(spark, sf):
    return dedup.dedup_key(T(spark, sf, "orders"), "o_custkey",
                           [F.col("o_totalprice").desc_nulls_last(), F.col("o_orderkey").asc_nulls_first()])


# ------------------------------------------------------------------ aggregates

@register("agg_basic", f"""SELECT l_returnflag, l_linestatus, count(*) AS row_count, count(l_tax) AS tax_values,
  {sum_rounded('l_quantity')} AS sum_qty, {avg_rounded('l_extendedprice', 2)} AS avg_price,
  min(l_discount) AS min_discount, max(l_discount) AS max_discount, {sum_rounded('l_extendedprice')} AS sum_price
FROM ({_LI_NULLS_SQL.replace('SELECT ', 'SELECT l_linestatus, l_extendedprice, l_discount, ', 1)})
GROUP BY l_returnflag, l_linestatus""")
def agg_basic(spark, sf):
    df = T(spark, sf, "lineitem").selectExpr(
        "l_linestatus", "l_extendedprice", "l_discount", *[f"{e} AS {k}" for k, e in _LI_NULLS.items()])
    return gold.group_summary(df, ["l_returnflag", "l_linestatus"], [
        gold.Measure("row_count", "count"), gold.Measure("tax_values", "count_col", "l_tax"),
        gold.Measure("sum_qty", "sum", "l_quantity", round=2),
        gold.Measure("avg_price", "avg", "l_extendedprice", round=2),
        gold.Measure("min_discount", "min", "l_discount"), gold.Measure("max_discount", "max", "l_discount"),
        gold.Measure("sum_price", "sum", "l_extendedprice", round=2)])


@register("agg_global", f"""SELECT count(*) AS line_count, {sum_rounded('l_extendedprice')} AS total_price,
  {avg_rounded('l_discount', 4)} AS avg_discount, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship,
  count(DISTINCT l_returnflag) AS flags FROM lineitem""")
def agg_global(spark, sf):
    return gold.global_summary(T(spark, sf, "lineitem"), [
        gold.Measure("line_count", "count"), gold.Measure("total_price", "sum", "l_extendedprice", round=2),
        gold.Measure("avg_discount", "avg", "l_discount", round=4),
        gold.Measure("first_ship", "min", "l_shipdate"), gold.Measure("last_ship", "max", "l_shipdate"),
        gold.Measure("flags", "count_distinct", "l_returnflag")])


@register("agg_count_distinct", """SELECT l_returnflag, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS suppliers,
  count(DISTINCT l_orderkey) AS orders FROM lineitem GROUP BY l_returnflag""")
def agg_count_distinct(spark, sf):
    return gold.group_summary(T(spark, sf, "lineitem"), ["l_returnflag"], [
        gold.Measure("parts", "count_distinct", "l_partkey"), gold.Measure("suppliers", "count_distinct", "l_suppkey"),
        gold.Measure("orders", "count_distinct", "l_orderkey")])


@register("agg_conditional", """SELECT o_orderpriority, cast(count_if(o_orderstatus = 'F') AS BIGINT) AS finished,
  cast(sum(CASE WHEN o_totalprice > 250000 THEN 1 ELSE 0 END) AS BIGINT) AS large_orders FROM orders GROUP BY o_orderpriority""")
def agg_conditional(spark, sf):
    return gold.group_summary(T(spark, sf, "orders"), ["o_orderpriority"], [
        gold.Measure("finished", "count_if", F.col("o_orderstatus") == "F"),
        gold.Measure("large_orders", "sum", F.when(F.col("o_totalprice") > 250000, 1).otherwise(0))])


@register("agg_multi_key", f"""SELECT o_orderstatus AS status, cast(year(o_orderdate) AS INTEGER) AS order_year,
  count(*) AS orders, {sum_rounded('o_totalprice')} AS revenue FROM orders GROUP BY o_orderstatus, year(o_orderdate)""")
def agg_multi_key(spark, sf):
    return gold.group_summary(T(spark, sf, "orders"),
                              [F.col("o_orderstatus").alias("status"), F.year("o_orderdate").alias("order_year")],
                              [gold.Measure("orders", "count"),
                               gold.Measure("revenue", "sum", "o_totalprice", round=2)])


@register("agg_dynamic", f"""SELECT c_mktsegment, count(*) AS customers, {avg_rounded('c_acctbal', 2)} AS avg_balance,
  {sum_rounded('c_acctbal')} AS total_balance FROM customer GROUP BY c_mktsegment""")
def agg_dynamic(spark, sf):
    c = T(spark, sf, "customer")
    ms = gold.measures_for(c.columns, {
        "*": [gold.Measure("customers", "count")],
        "c_acctbal": [gold.Measure("avg_balance", "avg", "c_acctbal", 2),
                      gold.Measure("total_balance", "sum", "c_acctbal", 2)],
        "c_age": [gold.Measure("avg_age", "avg", "c_age", 1)],
    })
    return gold.group_summary(c, ["c_mktsegment"], ms)


@register("agg_ratio", """SELECT l_orderkey, lines, total_qty, round(total_qty / lines, 2) AS qty_per_line FROM (
  SELECT l_orderkey, count(*) AS lines, sum(l_quantity) AS total_qty FROM lineitem GROUP BY l_orderkey)""")
def agg_ratio(spark, sf):
    g = gold.group_summary(T(spark, sf, "lineitem"), ["l_orderkey"], [
        gold.Measure("lines", "count"), gold.Measure("total_qty", "sum", "l_quantity")])
    return g.withColumn("qty_per_line", F.round(safe_ratio(F.col("total_qty"), F.col("lines")), 2))


@register("pct_of_total", f"""SELECT o_orderpriority, count(*) AS orders,
  {pct('count(*)', '(SELECT count(*) FROM orders)')} AS pct_of_total FROM orders
WHERE o_orderpriority <> '5-LOW' GROUP BY o_orderpriority""")
def pct_of_total(spark, sf):
    o = T(spark, sf, "orders")
    g = gold.group_summary(o, ["o_orderpriority"], [gold.Measure("orders", "count")])
    return gold.with_pct_of_total(g, "orders").filter(F.col("o_orderpriority") != "5-LOW")


@register("agg_completeness", f"""SELECT *, {pct('positive', 'customers')} AS positive_pct FROM (
  SELECT c_mktsegment, count(*) AS customers, cast(count_if(c_acctbal > 0) AS BIGINT) AS positive
  FROM customer GROUP BY c_mktsegment)""")
def agg_completeness(spark, sf):
    g = gold.group_summary(T(spark, sf, "customer"), ["c_mktsegment"], [
        gold.Measure("customers", "count"), gold.Measure("positive", "count_if", F.col("c_acctbal") > 0)])
    return gold.with_completeness(g, {"positive_pct": ("positive", "customers")})


# ------------------------------------------------------------------ sorts, limits, reshape

@register("sort_basic", "SELECT * FROM customer")
def sort_basic(spark, sf):
    return T(spark, sf, "customer").orderBy(F.col("c_name").desc())


@register("sort_multi", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def sort_multi(spark, sf):
    return T(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice") \
        .orderBy("o_orderstatus", F.col("o_totalprice").desc())


@register("sort_hidden", "SELECT l_orderkey, l_linenumber, round(l_extendedprice, 0) AS price_rounded FROM lineitem")
def sort_hidden(spark, sf):
    li = T(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", F.round("l_extendedprice", 0).alias("price_rounded")) \
        .orderBy(F.col("l_discount").asc(), F.col("l_orderkey"), F.col("l_linenumber"))


@register("top_k", f"SELECT * FROM lineitem ORDER BY l_extendedprice DESC, "
                   f"{', '.join(c + ' ASC' for c in _LI_ALL if c != 'l_extendedprice')} LIMIT 20")
def top_k(spark, sf):
    return gold.top_k(T(spark, sf, "lineitem"), [F.col("l_extendedprice").desc()]
                      + [F.col(c).asc() for c in _LI_ALL if c != "l_extendedprice"], 20)


_EVENT_TYPES = ["click", "view", "purchase", "signup", "error"]
_USER_FLAGS = ", ".join(f"max(CASE WHEN event_type = '{t}' THEN 1 ELSE 0 END) AS {t}" for t in _EVENT_TYPES)


@register("unpivot_days", f"""WITH u AS (SELECT user_id, {_USER_FLAGS} FROM events GROUP BY user_id)
{" UNION ALL ".join(f"SELECT user_id, '{t}' AS event_type, {t} AS seen FROM u" for t in _EVENT_TYPES)}""")
def unpivot_days(spark, sf):
    e = T(spark, sf, "events")
    per_user = e.groupBy("user_id").agg(
        *[F.max(F.when(F.col("event_type") == t, 1).otherwise(0)).alias(t) for t in _EVENT_TYPES])
    return per_user.unpivot(["user_id"], _EVENT_TYPES, "event_type", "seen")


# ------------------------------------------------------------------ profiles and reports

_PROFILE_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_PROFILE_TEXTS = ["l_returnflag", "l_linestatus"]
_PROFILE_SQL = [
    f"SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS stddev, "
    f"min({c}) AS min, max({c}) AS max, cast(NULL AS VARCHAR) AS min_text, cast(NULL AS VARCHAR) AS max_text FROM lineitem"
    for c in _PROFILE_COLS] + [
    f"SELECT '{c}', count({c}), NULL, NULL, NULL, NULL, min({c}), max({c}) FROM lineitem" for c in _PROFILE_TEXTS]


@register("profile_describe", " UNION ALL ".join(_PROFILE_SQL))
def profile_describe(spark, sf):
    return profile.profile_describe(T(spark, sf, "lineitem"), _PROFILE_COLS + _PROFILE_TEXTS)


# Largest distance of a quartile's rank from the true one that the check accepts.
_RANK_ERROR = 0.02


@register("profile_summary", f"SELECT *, true AS p25_in_bounds, true AS p50_in_bounds, true AS p75_in_bounds "
                             f"FROM ({' UNION ALL '.join(_PROFILE_SQL[:len(_PROFILE_COLS)])})")
def profile_summary(spark, sf):
    """The profile, with each quartile replaced by whether its rank is right, counted over all rows."""
    li = T(spark, sf, "lineitem")
    summary = profile.profile_summary(li, _PROFILE_COLS)
    long = li.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("x"))
                                         for c in _PROFILE_COLS])).alias("v")).select("v.*")
    marks = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    ranks = long.join(F.broadcast(summary.select("column_name", *marks)), "column_name").groupBy("column_name").agg(*[
        ((F.count_if(F.col("x") < F.col(p)) <= F.count("x") * (rank + _RANK_ERROR))
         & (F.count_if(F.col("x") <= F.col(p)) >= F.count("x") * (rank - _RANK_ERROR))).alias(f"{p}_in_bounds")
        for p, rank in marks.items()])
    return summary.drop(*marks).join(ranks, "column_name")


@register("layer_report", """SELECT * , round(cast(row_count AS double) * 100 / (SELECT count(*) FROM orders), 1) AS retention_pct,
  (SELECT count(*) FROM orders) - row_count AS removed_rows
FROM (SELECT 'source' AS layer, 'orders' AS table_name, count(*) AS row_count, 'OK' AS status FROM orders
  UNION ALL SELECT 'source', 'lineitem', count(*), 'OK' FROM lineitem
  UNION ALL SELECT 'derived', 'orders_finished', count(*), 'OK' FROM orders WHERE o_orderstatus = 'F'
  UNION ALL SELECT 'derived', 'not_built', CAST(NULL AS BIGINT), 'N/A')""")
def layer_report(spark, sf):
    o = T(spark, sf, "orders")
    return quality.layer_report([
        ("source", "orders", o), ("source", "lineitem", T(spark, sf, "lineitem")),
        ("derived", "orders_finished", o.filter(F.col("o_orderstatus") == "F")),
        ("derived", "not_built", None)], baseline=("source", "orders"))
