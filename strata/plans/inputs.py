"""The given tables mapped onto the input shape of each flow.

The test tables are a TPC-H-like star schema plus an event stream; each flow
of this package expects a different raw shape (nested train JSON, place
records, patient CSV, taxi trips, a job study). Every column below is one
SQL expression over a given table, written in the common subset of Spark SQL
and DuckDB, so the Spark side (``selectExpr``) and the SQL oracle read the
same definition. Nulls, blanks, padding, out-of-range values and bad codes
are placed by key arithmetic so every cleansing and quality rule has rows to
act on, and all of it grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _bit(key: str, k: int) -> str:
    return f"({key} & {2 ** k}) > 0"


# ---- trains: each line item is one record of its order's train --------------
TRAIN_COLUMNS = {
    "trainNumber": "concat(' ', cast(l_orderkey as string), ' ')",
    "trainName": "concat('Express ', cast(l_orderkey % 500 as string))",
    "route": "concat(' ', case l_orderkey % 5 when 0 then 'Agra' when 1 then 'Kochi' when 2 then 'Surat' "
             "when 3 then 'Patna' else 'Ranchi' end, ' to ', case l_orderkey % 3 when 0 then 'Delhi' "
             "when 1 then 'Mumbai' else 'Pune' end, ' ')",
}
TRAIN_DAYS = {d: _bit("l_orderkey", k) for k, d in enumerate(("MON", "TUE", "WED", "THU", "FRI", "SAT"))}
TRAIN_DAYS["SUN"] = f"case when l_orderkey % 101 = 0 then null else {_bit('l_orderkey', 6)} end"
STOP_COLUMNS = {
    "sno": "case when l_orderkey % 89 = 0 then 'x' else cast(l_linenumber as string) end",
    "stationName": "case when l_partkey % 50 = 0 then concat('HALT ', cast(l_partkey as string)) "
                   "else concat(' STATION ', cast(l_partkey % 300 as string), ' - S', "
                   "cast(l_partkey % 300 as string)) end",
    "arrives": "case when l_linenumber = 1 then 'Source' else concat(lpad(cast(l_suppkey % 24 as string), 2, '0'), "
               "':', lpad(cast(l_partkey % 60 as string), 2, '0')) end",
    "departs": "case when l_returnflag = 'R' then 'Destination' else concat(lpad(cast((l_suppkey + 1) % 24 as string), "
               "2, '0'), ':', lpad(cast((l_partkey + 7) % 60 as string), 2, '0')) end",
    "day": "case when l_linenumber < 3 then '1' when l_linenumber < 6 then '2' else '3' end",
    "distance": "case when l_discount = 0 then null when l_discount = 0.01 then 'n/a' "
                "when l_quantity >= 49 then concat(cast(cast(l_quantity as int) as string), ',050 kms') "
                "when l_tax = 0.08 then concat(cast(l_quantity as string), ' kms') "
                "else concat(cast(cast(l_quantity * 10 as int) as string), ' kms') end",
}
# The second stop of records that have one.
SECOND_STOP_COLUMNS = {
    "sno": "cast(l_linenumber + 10 as string)",
    "stationName": "concat('STATION ', cast(l_suppkey % 300 as string), ' - S', cast(l_suppkey % 300 as string))",
    "arrives": "concat(lpad(cast(l_partkey % 24 as string), 2, '0'), ':15')",
    "departs": "case when l_linestatus = 'F' then 'Destination' else concat(lpad(cast(l_partkey % 24 as string), 2, '0'), ':20') end",
    "day": "case when l_linenumber < 3 then '2' when l_linenumber < 6 then '3' else '4' end",
    "distance": "concat(cast(cast(l_quantity * 10 as int) + 500 as string), ' kms')",
}
NO_STOPS, TWO_STOPS = "l_partkey % 97 = 0", "l_partkey % 97 <> 0 and l_partkey % 4 = 1"


def trains_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One nested record per line item, built from that row alone: weekday struct and an array of
    one stop, two (``TWO_STOPS``) or a null array (``NO_STOPS``). A train has as many records as
    its order has line items."""
    first, second = (F.struct(*[F.expr(e).alias(n) for n, e in c.items()]) for c in (STOP_COLUMNS, SECOND_STOP_COLUMNS))
    # both stops are written once: an array in each branch of a condition would double the generated code
    stops = F.when(~F.expr(NO_STOPS), F.slice(F.array(first, second), F.lit(1), F.when(F.expr(TWO_STOPS), 2).otherwise(1)))
    return table(spark, sf_dir, "lineitem").select(
        *[F.expr(e).alias(n) for n, e in TRAIN_COLUMNS.items()],
        F.struct(*[F.expr(e).alias(d) for d, e in TRAIN_DAYS.items()]).alias("runningDays"),
        stops.alias("trainRoute"),
    )


# ---- places: customer ⋈ nation ⋈ region ----------------------------------------
PLACE_COLUMNS = {
    "id": "case when c_custkey % 97 = 0 then '' else concat(' ', cast(c_custkey as string), ' ') end",
    "name": "case when c_custkey % 89 = 0 then null else c_name end",
    "latitude": "case when c_custkey % 101 = 0 then 'n/a' "
                "else cast(cast((c_custkey * 37) % 1811 - 905 as double) / 10 as string) end",
    "longitude": "cast(cast((c_custkey * 53) % 3621 - 1810 as double) / 10 as string)",
    "address": "case when c_custkey % 5 = 0 then '' when c_custkey % 7 = 0 then null "
               "else concat(cast(c_custkey as string), ' Main St ') end",
    "city": "case when c_custkey % 11 = 0 then '  ' else n_name end",
    "state": "concat('ST-', cast(c_nationkey % 7 as string))",
    "zip": "lpad(cast(c_custkey % 100000 as string), 5, '0')",
    "country": "case when c_custkey % 83 = 0 then null when c_custkey % 13 = 0 then lower(r_name) "
               "else concat(' ', r_name) end",
    "url": "case when c_custkey % 3 = 0 then null else concat('www.place', cast(c_custkey as string), '.test') end",
    "phone": "case when c_custkey % 4 = 0 then null when c_custkey % 9 = 0 then '' "
             "else concat('+1 (555) ', lpad(cast(c_custkey % 1000 as string), 3, '0'), '-', "
             "lpad(cast(c_custkey % 10000 as string), 4, '0')) end",
    "categories": "case when c_custkey % 17 = 0 then '' else c_mktsegment end",
    "point_of_interest": "concat('P_', cast(c_custkey as string))",
}


def places_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One place per customer; city = nation, country = region.

    nation and region are fixed-size dimension tables (25 and 5 rows), so
    Catalyst broadcasts them from their file statistics; the customer side
    is never shuffled.
    """
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    joined = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    return joined.select(*[F.expr(e).alias(k) for k, e in PLACE_COLUMNS.items()])


# ---- patients: orders ⋈ customer, some visits duplicated ----------------------
PATIENT_COPIES = "case when o_orderkey % 10 = 0 or o_orderkey % 15 = 0 then 1 else 0 end"
PATIENT_COLUMNS = {
    "Name": "case when o_orderkey % 41 = 0 then upper(c_name) else concat('  ', lower(c_name), ' ') end",
    "Age": "cast(case when c_custkey % 67 = 0 then 17 else 18 + c_custkey % 68 end as int)",
    "Gender": "case when c_custkey % 2 = 0 then 'Male' else 'Female' end",
    "Blood Type": "case o_orderkey % 4 when 0 then 'a+' when 1 then 'B-' when 2 then 'o+' else 'AB-' end",
    "Medical Condition": "o_orderpriority",
    "Date of Admission": "cast(o_orderdate as date)",
    "Doctor": "concat('dr. doctor', cast(o_custkey % 8 as string))",
    "Hospital": "c_mktsegment",
    "Insurance Provider": "concat('Insurer ', cast(o_orderkey % 5 as string))",
    "Billing Amount": "case when o_orderkey % 53 = 0 then -o_totalprice when o_orderkey % 59 = 0 then null "
                      "when copy_no = 1 and o_orderkey % 10 = 0 then o_totalprice - 100 "
                      "else o_totalprice + cast(o_orderkey % 9 as double) / 1000 end",
    "Room Number": "cast(100 + o_orderkey % 401 as int)",
    "Admission Type": "case o_orderstatus when 'F' then 'Elective' when 'O' then 'Emergency' else 'Urgent' end",
    "Discharge Date": "cast(o_orderdate as date) + cast(1 + o_orderkey % 30 as int)",
    "Medication": "concat('Med', cast(o_orderkey % 5 as string))",
    "Test Results": "case o_orderkey % 3 when 0 then 'Normal' when 1 then 'Abnormal' else 'Inconclusive' end",
}


def patients_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One admission per order (CSV header names); every 10th order also appears with a
    lower bill (same visit), every 15th as an exact copy."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    joined = o.join(c, o.o_custkey == c.c_custkey)
    copies = joined.withColumn("copy_no", F.explode(F.sequence(F.lit(0), F.expr(PATIENT_COPIES))))
    return copies.select(*[F.expr(e).alias(k) for k, e in PATIENT_COLUMNS.items()])


# ---- trips: events ---------------------------------------------------------------
TRIP_COLUMNS = {
    "VendorID": "cast(case when event_id % 23 = 0 then null else 1 + event_id % 3 end as int)",
    "lpep_pickup_datetime": "case when event_id % 211 = 0 then null else ts end",
    "lpep_dropoff_datetime": "ts + INTERVAL '1' MINUTE * cast(event_id % 97 - 5 as int)",
    "store_and_fwd_flag": "case when event_id % 11 = 0 then 'X' when event_id % 2 = 0 then 'Y' else 'N' end",
    "RatecodeID": "cast(case when event_id % 13 = 0 then null else 1 + event_id % 7 end as int)",
    "PULocationID": "cast(user_id % 265 as int)",
    "DOLocationID": "cast((user_id * 7 + event_id) % 265 as int)",
    "passenger_count": "cast(case when event_id % 17 = 0 then null else event_id % 8 end as int)",
    "trip_distance": "case when event_id % 401 = 0 then 250.0 else cast(event_id % 300 as double) / 4 end",
    "fare_amount": "case when event_id % 29 = 0 then null when event_type = 'error' then -value "
                   "when event_id % 113 = 0 then value + 500 else value + cast(event_id % 7 as double) / 1000 end",
    "tip_amount": "case when event_id % 37 = 0 then -1.5 else cast(event_id % 20 as double) / 4 end",
    "total_amount": "case when event_type = 'error' then -value else value end + cast(event_id % 20 as double) / 4",
    "payment_type": "cast(1 + event_id % 7 as int)",
    "trip_type": "cast(1 + event_id % 2 as int)",
    "congestion_surcharge": "case when event_id % 5 = 0 then null else cast(2.75 as double) end",
    "ehail_fee": "cast(null as double)",
}


def trips_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One trip per event: fare = value, pickup = ts, dropoff a whole number of minutes later."""
    return table(spark, sf_dir, "events").selectExpr(*[f"{e} AS {k}" for k, e in TRIP_COLUMNS.items()])


# ---- study: lineitem ---------------------------------------------------------------
STUDY_COLUMNS = {
    "job_id": "cast(l_orderkey * 8 + l_linenumber as int)",
    "job_role": "concat('Role ', cast(l_partkey % 40 as string))",
    "industry": "concat('Industry ', cast(l_suppkey % 12 as string))",
    "country": "case l_returnflag when 'A' then 'India' when 'N' then 'Brazil' else 'Germany' end",
    "year": "cast(year(l_shipdate) as int)",
    "automation_risk_percent": "l_tax * 1000",
    "automation_risk_category": "case when l_tax < 0.03 then 'Low' when l_tax < 0.06 then 'Medium' else 'High' end",
    "ai_replacement_score": "l_discount * 1000",
    "skill_gap_index": "cast(l_linenumber as double)",
    "salary_before_usd": "l_extendedprice",
    "salary_after_usd": "l_extendedprice + (l_tax - l_discount) * 100",
    "salary_change_percent": "(l_tax - l_discount) * 100",
    "skill_demand_growth_percent": "l_quantity",
    "remote_feasibility_score": "l_discount * 100",
    "education_requirement_level": "cast(l_linenumber as int)",
    "ai_adoption_level": "l_quantity * 2",
    "skill_transition_pressure": "l_tax * 100",
    "wage_volatility_index": "l_discount + l_tax",
    "reskilling_urgency_score": "l_quantity / 5",
    "ai_disruption_intensity": "l_quantity * l_discount",
}


def study_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(*[f"{e} AS {k}" for k, e in STUDY_COLUMNS.items()])


def select_list(columns: dict[str, str]) -> str:
    """``expr AS "name"`` list for the SQL oracle (names quoted: some contain spaces)."""
    return ", ".join(f'{e} AS "{k}"' for k, e in columns.items())
