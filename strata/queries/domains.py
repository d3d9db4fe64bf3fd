"""Checks of the five flows' layers (silver and gold) on the adapted test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.plans import inputs, patients, patients_roles, places, study, trains, trips
from strata.queries import register
from strata.queries.sqlhelp import (
    DAYS, PATIENTS_RAW, PLACES_CTE, STUDY_RAW, TRAINS_BRONZE, TRAINS_CTE, TRAINS_WITHOUT_STOPS, TRIPS_RAW, avg_rounded, initcap, pct,
    rounded, sum_exact, sum_rounded,
)
from strata.sources import generate

# ---------------------------------------------------------------- trains


def _trains_silver(spark: SparkSession, sf: str) -> DataFrame:
    raw = inputs.trains_raw(spark, sf)
    clean, _ = trains.split_stops(trains.silver_stops(trains.bronze_stops(raw)))
    return clean


@register("flatten_nested", TRAINS_BRONZE)
def flatten_nested(spark, sf):
    return trains.bronze_stops(inputs.trains_raw(spark, sf))


@register("flatten_nested_outer", f"{TRAINS_BRONZE} UNION ALL {TRAINS_WITHOUT_STOPS}")
def flatten_nested_outer(spark, sf):
    return trains.bronze_stops(inputs.trains_raw(spark, sf), keep_empty=True)


@register("silver_stops", f"{TRAINS_CTE} SELECT * FROM trains_silver")
def silver_stops(spark, sf):
    return _trains_silver(spark, sf).drop("ingested_at")


_DAY_MAX = ", ".join(f"max(cast({d} AS INTEGER)) AS {d}" for d in DAYS)
_DAY_SUM = " + ".join(DAYS)


@register("gold_route_summary", f"""{TRAINS_CTE}
SELECT *, {_DAY_SUM} AS days_per_week, round(total_distance_km / total_stops, 2) AS avg_km_per_stop FROM (
  SELECT trainNumber, trainName, route, origin, destination, count(stop_number) AS total_stops,
    max(distance_km) AS total_distance_km, max(stop_number) AS max_stop_number,
    count(DISTINCT station_name) AS unique_stations, max(day) AS journey_days, {_DAY_MAX}
  FROM trains_silver GROUP BY trainNumber, trainName, route, origin, destination)""")
def gold_route_summary(spark, sf):
    return trains.gold_route_summary(_trains_silver(spark, sf))


@register("gold_station_frequency", f"""{TRAINS_CTE}
SELECT station_name, station_code, count(DISTINCT trainNumber) AS train_count, count(*) AS total_stop_events,
  count(DISTINCT route) AS unique_routes FROM trains_silver GROUP BY station_name, station_code""")
def gold_station_frequency(spark, sf):
    return trains.gold_station_frequency(_trains_silver(spark, sf))


_RUNNING_DAYS_SQL = f"""{TRAINS_CTE},
days AS (SELECT trainNumber, {_DAY_MAX} FROM trains_silver GROUP BY trainNumber),
long AS ({" UNION ALL ".join(f"SELECT '{d}' AS day_name, {d} AS runs FROM days" for d in DAYS)})
SELECT day_name, cast(sum(runs) AS BIGINT) AS train_count, {pct('sum(runs)', 'count(*)')} AS pct_of_trains
FROM long GROUP BY day_name"""


@register("gold_running_days", _RUNNING_DAYS_SQL)
def gold_running_days(spark, sf):
    return trains.gold_running_days(_trains_silver(spark, sf))


# ---------------------------------------------------------------- places


def _places_silver(spark: SparkSession, sf: str) -> DataFrame:
    bronze = places.bronze_places(inputs.places_raw(spark, sf))
    clean, _ = places.split_places(places.silver_places(bronze))
    return clean


@register("silver_places", f"{PLACES_CTE} SELECT * FROM places_silver")
def silver_places(spark, sf):
    return _places_silver(spark, sf).drop("ingested_at", "silver_ingested_at")


@register("gold_country_summary", f"""{PLACES_CTE}
SELECT *, {pct('poi_count', '(SELECT count(*) FROM places_silver)')} AS pct_of_total,
  {pct('with_address', 'poi_count')} AS address_completeness_pct,
  {pct('with_contact', 'poi_count')} AS contact_completeness_pct FROM (
  SELECT country, count(*) AS poi_count, count(DISTINCT city) AS unique_cities,
    count(DISTINCT categories) AS unique_categories,
    {avg_rounded('latitude', 4)} AS avg_latitude, {avg_rounded('longitude', 4)} AS avg_longitude,
    cast(count_if(has_address) AS BIGINT) AS with_address, cast(count_if(has_contact) AS BIGINT) AS with_contact
  FROM places_silver GROUP BY country)""")
def gold_country_summary(spark, sf):
    return places.gold_country_summary(_places_silver(spark, sf))


@register("gold_category_distribution", f"""{PLACES_CTE}
SELECT categories, count(*) AS poi_count, count(DISTINCT country) AS countries_present,
  count(DISTINCT city) AS unique_cities, {pct('count(*)', '(SELECT count(*) FROM places_silver)')} AS pct_of_total
FROM places_silver WHERE categories IS NOT NULL AND categories <> '' GROUP BY categories""")
def gold_category_distribution(spark, sf):
    return places.gold_category_distribution(_places_silver(spark, sf))


@register("gold_city_density", f"""{PLACES_CTE}
SELECT city, state, country, count(*) AS poi_count, count(DISTINCT categories) AS unique_categories,
  {avg_rounded('latitude', 6)} AS center_latitude, {avg_rounded('longitude', 6)} AS center_longitude
FROM places_silver WHERE city IS NOT NULL AND city <> '' GROUP BY city, state, country""")
def gold_city_density(spark, sf):
    return places.gold_city_density(_places_silver(spark, sf))


# ---------------------------------------------------------------- patients (mapped columns)

_MAPPED = ", ".join(f'"{k}" AS {v}' for k, v in patients.COLUMN_MAPPING.items())
_TIES = ", ".join(f"{c} ASC NULLS FIRST" for c in patients.COLUMN_MAPPING.values()
                  if c not in patients.DEDUP_KEYS and c != patients.DEDUP_ORDER_COL)
PATIENTS_B_CTE = f"""WITH raw AS ({PATIENTS_RAW}),
bronze AS (SELECT {_MAPPED} FROM raw),
named AS (SELECT * REPLACE ({initcap('trim(name)')} AS name) FROM bronze),
ranked AS (SELECT *, row_number() OVER (PARTITION BY {", ".join(patients.DEDUP_KEYS)}
  ORDER BY billing_amount DESC NULLS LAST, {_TIES}) AS rn FROM named WHERE billing_amount >= 0),
silver AS (SELECT * EXCLUDE (rn), cast(datediff('day', admission_date, discharge_date) AS INTEGER) AS length_of_stay
  FROM ranked WHERE rn = 1)"""


def _patients_silver(spark: SparkSession, sf: str) -> DataFrame:
    return patients.silver_patients(patients.bronze_patients(inputs.patients_raw(spark, sf)))


@register("silver_patients", f"{PATIENTS_B_CTE} SELECT * FROM silver")
def silver_patients(spark, sf):
    return _patients_silver(spark, sf).drop("ingestion_timestamp")


def _b_money(name: str, fn: str) -> str:
    if fn == "avg":
        return f"{avg_rounded('billing_amount', 2)} AS {name}"
    if fn == "sum":
        return f"{sum_rounded('billing_amount')} AS {name}"
    return f"{rounded(f'{fn}(billing_amount)', 2)} AS {name}"


_AVG_LOS = f"{avg_rounded('length_of_stay', 1)} AS avg_length_of_stay"


@register("gold_condition_summary", f"""{PATIENTS_B_CTE}
SELECT medical_condition, count(*) AS patient_count, {avg_rounded('age', 1)} AS avg_age,
  {_b_money('avg_billing', 'avg')}, {_b_money('min_billing', 'min')}, {_b_money('max_billing', 'max')},
  {_AVG_LOS}, {_b_money('total_billing', 'sum')}
FROM silver GROUP BY medical_condition""")
def gold_condition_summary(spark, sf):
    return patients.gold_condition_summary(_patients_silver(spark, sf))


@register("gold_admission_summary", f"""{PATIENTS_B_CTE}
SELECT admission_type, insurance_provider, count(*) AS patient_count, {_b_money('avg_billing', 'avg')},
  {_AVG_LOS}, {_b_money('total_billing', 'sum')}
FROM silver GROUP BY admission_type, insurance_provider""")
def gold_admission_summary(spark, sf):
    return patients.gold_admission_summary(_patients_silver(spark, sf))


@register("gold_hospital_performance", f"""{PATIENTS_B_CTE}
SELECT hospital, count(*) AS total_patients, count(DISTINCT doctor) AS unique_doctors,
  count(DISTINCT medical_condition) AS conditions_treated, {_b_money('avg_billing', 'avg')}, {_AVG_LOS},
  {_b_money('total_revenue', 'sum')}
FROM silver GROUP BY hospital""")
def gold_hospital_performance(spark, sf):
    return patients.gold_hospital_performance(_patients_silver(spark, sf))


# ---------------------------------------------------------------- patients (roles)

_PROPER = ("Name", "Doctor", "Hospital")
_UPPER = ("Gender", "Blood Type", "Admission Type", "Test Results")
_TEXT = ("Medical Condition", "Insurance Provider", "Medication")


def _role_expr(c: str) -> str:
    if c in _PROPER:
        return f'{initcap(f"trim(\"{c}\")")} AS "{c}"'
    if c in _UPPER:
        return f'upper(trim("{c}")) AS "{c}"'
    if c in _TEXT:
        return f'trim("{c}") AS "{c}"'
    return f'"{c}"'


PATIENTS_A_CTE = f"""WITH raw AS ({PATIENTS_RAW}),
dedup AS (SELECT DISTINCT * FROM raw),
silver AS (SELECT {", ".join(_role_expr(c) for c in generate.CSV_HEADER)},
  cast(datediff('day', "Date of Admission", "Discharge Date") AS INTEGER) AS length_of_stay_days,
  CASE WHEN "Age" < 18 THEN 'Pediatric' WHEN "Age" < 40 THEN 'Young Adult' WHEN "Age" < 60 THEN 'Middle Aged'
       ELSE 'Senior' END AS age_group,
  CASE WHEN "Billing Amount" < 10000 THEN 'Low' WHEN "Billing Amount" < 25000 THEN 'Medium'
       WHEN "Billing Amount" < 40000 THEN 'High' ELSE 'Very High' END AS billing_category
  FROM dedup)"""


def _roles_silver(spark: SparkSession, sf: str) -> DataFrame:
    bronze = patients_roles.bronze_patients(inputs.patients_raw(spark, sf), "patients.csv")
    return patients_roles.silver_patients(bronze)


@register("silver_patients_roles", f"{PATIENTS_A_CTE} SELECT * FROM silver")
def silver_patients_roles(spark, sf):
    return _roles_silver(spark, sf).drop("_silver_processed_at", "_silver_record_id")


_A_BILL = (f"{avg_rounded('\"Billing Amount\"', 2)} AS avg_billing_amount, "
           f"{sum_rounded('\"Billing Amount\"')} AS total_revenue")
_A_LOS = f"{avg_rounded('length_of_stay_days', 1)} AS avg_length_of_stay"


@register("gold_condition_analytics", f"""{PATIENTS_A_CTE}
SELECT "Medical Condition" AS medical_condition, count(*) AS total_admissions, {_A_BILL}, {_A_LOS},
  {avg_rounded('"Age"', 1)} AS avg_age, min("Age") AS min_age, max("Age") AS max_age
FROM silver GROUP BY "Medical Condition" """)
def gold_condition_analytics(spark, sf):
    return patients_roles.gold_condition_analytics(_roles_silver(spark, sf)).drop("_gold_processed_at")


@register("gold_hospital_metrics", f"""{PATIENTS_A_CTE}
SELECT "Hospital" AS hospital, count(*) AS total_patients, {_A_BILL}, {_A_LOS} FROM silver GROUP BY "Hospital" """)
def gold_hospital_metrics(spark, sf):
    return patients_roles.gold_hospital_metrics(_roles_silver(spark, sf)).drop("_gold_processed_at")


@register("gold_insurer_revenue", f"""{PATIENTS_A_CTE}
SELECT "Insurance Provider" AS insurance_provider, count(*) AS total_patients, {_A_BILL},
  {rounded('min("Billing Amount")', 2)} AS min_billing, {rounded('max("Billing Amount")', 2)} AS max_billing
FROM silver GROUP BY "Insurance Provider" """)
def gold_insurer_revenue(spark, sf):
    return patients_roles.gold_insurer_revenue(_roles_silver(spark, sf)).drop("_gold_processed_at")


@register("gold_demographics", f"""{PATIENTS_A_CTE}
SELECT age_group, "Gender" AS gender, count(*) AS patient_count, {_A_BILL}, {avg_rounded('"Age"', 1)} AS avg_age,
  {_A_LOS} FROM silver GROUP BY age_group, "Gender" """)
def gold_demographics(spark, sf):
    return patients_roles.gold_demographics(_roles_silver(spark, sf)).drop("_gold_processed_at")


# ---------------------------------------------------------------- trips

TRIPS_BAD = ("coalesce(fare_amount < 0 OR total_amount < 0 OR trip_distance > 200 "
             "OR lpep_dropoff_datetime < lpep_pickup_datetime, false)")
TRIPS_CTE = f"""WITH raw AS ({TRIPS_RAW}),
clean AS (SELECT * FROM raw WHERE NOT {TRIPS_BAD}),
dur AS (SELECT * EXCLUDE (ehail_fee),
  round(datediff('second', lpep_pickup_datetime, lpep_dropoff_datetime) / 60, 2) AS trip_duration_minutes FROM clean),
silver AS (SELECT * REPLACE (coalesce(passenger_count, 1) AS passenger_count,
    coalesce(congestion_surcharge, 0.0) AS congestion_surcharge, coalesce(RatecodeID, 1) AS RatecodeID),
  round(CASE WHEN trip_duration_minutes > 0 AND trip_distance > 0
             THEN trip_distance / (trip_duration_minutes / 60) END, 2) AS speed_mph,
  coalesce(trip_distance > 10, false) AS is_long_trip, cast(lpep_pickup_datetime AS DATE) AS pickup_date,
  cast(hour(lpep_pickup_datetime) AS INTEGER) AS pickup_hour FROM dur)"""


def _trips_silver(spark: SparkSession, sf: str) -> DataFrame:
    clean, _ = trips.split_trips(inputs.trips_raw(spark, sf))
    return trips.silver_trips(clean)


@register("silver_trips", f"{TRIPS_CTE} SELECT * FROM silver")
def silver_trips(spark, sf):
    return _trips_silver(spark, sf).drop("_processed_at")


def _avg2(c: str, name: str) -> str:
    return f"{avg_rounded(c, 2)} AS {name}"


_HOURLY = ", ".join([_avg2("fare_amount", "avg_fare"), _avg2("trip_distance", "avg_distance"),
                     _avg2("trip_duration_minutes", "avg_duration_min"), _avg2("tip_amount", "avg_tip")])


@register("gold_daily", f"""{TRIPS_CTE}
SELECT pickup_date, count(*) AS total_trips, {sum_exact('total_amount')} AS total_revenue, {_HOURLY},
  cast(count_if(is_long_trip) AS BIGINT) AS long_trips, {_avg2('speed_mph', 'avg_speed_mph')},
  {_avg2('passenger_count', 'avg_passengers')}
FROM silver GROUP BY pickup_date""")
def gold_daily(spark, sf):
    return trips.gold_daily(_trips_silver(spark, sf))


@register("gold_hourly", f"{TRIPS_CTE} SELECT pickup_hour, count(*) AS total_trips, {_HOURLY} "
                         f"FROM silver GROUP BY pickup_hour")
def gold_hourly(spark, sf):
    return trips.gold_hourly(_trips_silver(spark, sf))


_LOCATIONS_SQL = f"""{TRIPS_CTE}, located AS (
  SELECT 'pickup' AS location_type, PULocationID AS location_id, total_amount, fare_amount FROM silver
  UNION ALL SELECT 'dropoff', DOLocationID, total_amount, fare_amount FROM silver)
SELECT location_type, location_id, count(*) AS trip_count, {sum_rounded('total_amount')} AS total_revenue,
  {_avg2('fare_amount', 'avg_fare')} FROM located GROUP BY location_type, location_id"""


@register("gold_top_locations", _LOCATIONS_SQL)
def gold_top_locations(spark, sf):
    return trips.gold_top_locations(_trips_silver(spark, sf))


@register("union_tagged", _LOCATIONS_SQL)
def union_tagged(spark, sf):
    return trips.gold_top_locations_union(_trips_silver(spark, sf))


# ---------------------------------------------------------------- study

_STUDY_REPORT = f"""WITH study AS ({STUDY_RAW})
SELECT job_id, job_role, industry, country, year, round(ai_adoption_level, 2) AS ai_adoption_level,
  round(salary_before_usd, 2) AS salary_before_usd, round(salary_after_usd, 2) AS salary_after_usd,
  round(salary_change_percent, 2) AS salary_change_pct, automation_risk_category
FROM study WHERE ai_adoption_level >= 70 AND salary_change_percent < 0"""


@register("study_high_adoption", _STUDY_REPORT)
def study_high_adoption(spark, sf):
    return study.high_adoption_salary_drop(inputs.study_raw(spark, sf))


@register("distinct_count", f"SELECT count(*) AS distinct_job_roles FROM (SELECT DISTINCT job_role FROM "
                            f"({_STUDY_REPORT}))")
def distinct_count_key(spark, sf):
    return study.distinct_roles(study.high_adoption_salary_drop(inputs.study_raw(spark, sf)))


# ---------------------------------------------------------------- synthetic patients


def _sql_mix(salt: int) -> str:
    digest = f"sha256(concat(cast(id AS VARCHAR), ':{salt}'))"
    return f"cast(concat('0x', substr({digest}, 1, {generate.HASH_DIGITS})) AS BIGINT)"


def _sql_pick(values: list[str], salt: int) -> str:
    lits = ", ".join("'" + v.replace("'", "''") + "'" for v in values)
    return f"[{lits}][{_sql_mix(salt)} % {len(values)} + 1]"


def _sql_between(lo: int, hi: int, salt: int) -> str:
    return f"cast({lo} + {_sql_mix(salt)} % {hi - lo + 1} AS INTEGER)"


_G = generate
_GEN_SQL = f"""WITH ids AS (SELECT o_orderkey AS id FROM orders),
g AS (SELECT *, DATE '{_G.START_DATE}' + {_sql_between(0, _G.ADMISSION_SPAN_DAYS - 1, 6)} AS adm,
  {_G.BILLING_RANGE[0] * 100} + {_sql_mix(10)}
    % {(_G.BILLING_RANGE[1] - _G.BILLING_RANGE[0]) * 100 + 1} AS cents FROM ids)
SELECT concat_ws(' ', {_sql_pick(_G.FIRST_NAMES, 1)}, {_sql_pick(_G.LAST_NAMES, 2)}) AS "Name",
  {_sql_between(*_G.AGE_RANGE, 3)} AS "Age", {_sql_pick(_G.GENDERS, 4)} AS "Gender",
  {_sql_pick(_G.BLOOD_TYPES, 5)} AS "Blood Type", {_sql_pick(_G.CONDITIONS, 7)} AS "Medical Condition",
  adm AS "Date of Admission", {_sql_pick(_G.DOCTORS, 8)} AS "Doctor", {_sql_pick(_G.HOSPITALS, 9)} AS "Hospital",
  {_sql_pick(_G.INSURERS, 12)} AS "Insurance Provider", cast(cents AS DOUBLE) / 100.0 AS "Billing Amount",
  {_sql_between(*_G.ROOM_RANGE, 13)} AS "Room Number", {_sql_pick(_G.ADMISSION_TYPES, 14)} AS "Admission Type",
  adm + {_sql_between(*_G.STAY_DAYS, 15)} AS "Discharge Date", {_sql_pick(_G.MEDICATIONS, 16)} AS "Medication",
  {_sql_pick(_G.TEST_RESULTS, 17)} AS "Test Results" FROM g"""


@register("gen_patients", _GEN_SQL)
def gen_patients(spark, sf):
    return generate.gen_patients(inputs.table(spark, sf, "orders").select(F.col("o_orderkey").alias("id")))
