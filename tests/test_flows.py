"""The five flows on hand-made edge rows (the cases listed for each dataset)."""

import datetime as dt

from pyspark.sql import functions as F

from strata.operators import quality
from strata.plans import patients, patients_roles, places, study, trains, trips
from strata.sources.generate import gen_patients

ROUTE = "array<struct<sno:string,stationName:string,arrives:string,departs:string,day:string,distance:string>>"
DAYS = "struct<MON:boolean,TUE:boolean,WED:boolean,THU:boolean,FRI:boolean,SAT:boolean,SUN:boolean>"


def _trains_raw(spark):
    wk = (True, False, True, False, True, False, None)
    rows = [
        (" 12461 ", " Mandore Exp ", " Jodhpur to Delhi ", wk, [
            ("1", " MARWAR JN - MJ ", "Source", "10:00", "1", "0 kms"),
            ("2", "PALI - PL", "10:40", "10:45", "1", "25 kms"),
            ("x", "AJMER - AII", "12:00", "12:05", "1", "1,234 kms"),
            ("4", "HALT", "13:00", "13:01", "1", "25.7 kms"),
            ("5", "DELHI - DLI", "20:00", "Destination", "2", "n/a"),
            ("6", "AGRA - AGC", "21:00", "21:05", "2", None)]),
        ("12462", "Empty Route", "A to B", wk, []),
        ("12463", "Null Route", "A to B", wk, None),
        (" 12461 ", " Mandore Exp ", " Jodhpur to Delhi ", (False, True, True, False, True, False, False), [
            ("7", "KOTA - KOTA", "22:00", "22:10", "2", "300 kms")]),
    ]
    return spark.createDataFrame(rows, f"trainNumber string, trainName string, route string, runningDays {DAYS}, "
                                       f"trainRoute {ROUTE}")


def test_trains_layers(spark):
    bronze = trains.bronze_stops(_trains_raw(spark))
    assert bronze.count() == 7                                         # empty/null routes vanish
    silver = trains.silver_stops(bronze)
    assert silver.columns == list(trains.SILVER_COLUMNS)
    clean, bad = trains.split_stops(silver)
    assert clean.count() + bad.count() == 7
    rows = {r.stop_number: r for r in clean.collect()}
    assert rows[1].station_name == "MARWAR JN" and rows[1].station_code == "MJ" and rows[1].is_source
    assert rows[1].arrival_time is None and rows[1].origin == "Jodhpur" and rows[1].destination == "Delhi"
    assert rows[2].distance_km == 25.0
    stop5 = silver.filter(F.col("stop_number") == 5).first()
    assert stop5.is_destination and stop5.departure_time is None
    bad_reasons = {(r.station_name, r.stop_number, r.distance_km) for r in bad.collect()}
    assert ("AJMER", None, 1.0) in bad_reasons                          # non-numeric stop number
    assert ("", 4, 25.0) in bad_reasons                                 # station without code
    assert ("DELHI", 5, None) in bad_reasons and ("AGRA", 6, None) in bad_reasons


def test_trains_gold(spark):
    clean, _ = trains.split_stops(trains.silver_stops(trains.bronze_stops(_trains_raw(spark))))
    route = trains.gold_route_summary(clean).first()
    assert (route.total_stops, route.total_distance_km, route.max_stop_number) == (3, 300.0, 7)
    assert route.MON == 1 and route.TUE == 1 and route.SUN == 0 and route.days_per_week == 4
    assert route.avg_km_per_stop == 100.0
    days = [(r.day_name, r.train_count, r.pct_of_trains) for r in trains.gold_running_days(clean).collect()]
    assert days[0] == ("MON", 1, 100.0) and days[-1] == ("SUN", 0, 0.0) and len(days) == 7
    freq = {r.station_name: r.total_stop_events for r in trains.gold_station_frequency(clean).collect()}
    assert freq == {"MARWAR JN": 1, "PALI": 1, "KOTA": 1}


def _places_raw(spark):
    cols = "id string, name string, latitude string, longitude string, address string, city string, state string, " \
           "zip string, country string, url string, phone string, categories string, point_of_interest string"
    rows = [
        ("1", "Cafe", "90", "180", " 1 Main ", "Paris", "IDF", "75001", " fr ", None, "+1 (555) 010-2000", "Food", "P1"),
        ("2", "Bar", "90.1", "0", "", "Paris", "IDF", "75001", "FR", "", None, "Food", "P2"),
        ("3", "Inn", "-90", "-180.5", None, " ", "X", "1", "US", None, None, "", "P3"),
        (" ", "Shop", "10", "10", "x", "Rome", "LZ", "1", "IT", None, "", "Retail", "P4"),
        ("5", None, "10", "10", "x", "Rome", "LZ", "1", "IT", None, None, "Retail", "P5"),
        ("6", "Hut", None, "10", "x", "Rome", "LZ", "1", None, None, None, "Retail", "P6"),
        ("7", "Spa", "45", "45", "y", "Rome", "LZ", "1", "it", "u", None, " ", "P7"),
    ]
    return spark.createDataFrame(rows, cols)


def test_places(spark):
    silver = places.silver_places(places.bronze_places(_places_raw(spark)))
    clean, bad = places.split_places(silver)
    assert sorted(r.point_of_interest for r in clean.collect()) == ["P1", "P7"]
    assert bad.count() == 5
    p1 = {r.point_of_interest: r for r in silver.collect()}
    assert p1["P1"].country == "FR" and p1["P1"].phone_clean == "+15550102000" and p1["P1"].has_address
    assert not p1["P2"].has_address and p1["P2"].has_contact               # empty url still counts as contact
    strict = places.silver_places(places.bronze_places(_places_raw(spark)), strict_contact=True)
    assert not {r.point_of_interest: r for r in strict.collect()}["P2"].has_contact
    country = {r.country: r for r in places.gold_country_summary(clean).collect()}
    assert country["FR"].pct_of_total == 50.0 and country["IT"].address_completeness_pct == 100.0
    cats = places.gold_category_distribution(clean).collect()
    assert [(r.categories, r.pct_of_total) for r in cats] == [("Food", 50.0)]   # blank category dropped
    assert places.gold_city_density(clean).count() == 2


def _patients_raw(spark):
    d = dt.date(2023, 1, 1)
    base = ("  aLIce smith ", 40, "Female", "A+", "Asthma", d, "Dr. X", "H1", "Cigna", 100.0, 101, "Urgent",
            d + dt.timedelta(days=3), "Aspirin", "Normal")
    rows = [base, base[:9] + (250.0,) + base[10:], base[:9] + (-5.0,) + base[10:], base[:9] + (None,) + base[10:],
            ("Bob", 17, "Male", "o-", "Cancer", d, "Dr. Y", "H2", "Aetna", 9999.99, 200, "Emergency",
             d + dt.timedelta(days=1), "Lipitor", "Abnormal")]
    schema = ", ".join(f"`{c}` {t}" for c, t in zip(
        patients.COLUMN_MAPPING, ["string", "int", "string", "string", "string", "date", "string", "string", "string",
                                  "double", "int", "string", "date", "string", "string"]))
    return spark.createDataFrame(rows, schema)


def test_patients_mapped(spark):
    bronze = patients.bronze_patients(_patients_raw(spark))
    assert bronze.columns == list(patients.COLUMN_MAPPING.values())
    rep = patients.non_negative_report(bronze, "billing_amount").first()
    assert (rep.negative_rows, rep.null_rows, rep.kept_rows) == (1, 1, 3)
    silver = patients.silver_patients(bronze)
    rows = {r.name: r for r in silver.collect()}
    assert rows["Alice Smith"].billing_amount == 250.0 and rows["Alice Smith"].length_of_stay == 3
    assert silver.count() == 2
    g = {r.medical_condition: r for r in patients.gold_condition_summary(silver).collect()}
    assert g["Asthma"].total_billing == 250.0 and g["Cancer"].avg_age == 17.0


def test_patients_roles(spark):
    raw = _patients_raw(spark).unionByName(_patients_raw(spark).limit(1))
    bronze = patients_roles.bronze_patients(raw, "healthcare.csv")
    assert {"_row_hash", "_source_file", "_ingested_at"} <= set(bronze.columns)
    silver = patients_roles.silver_patients(bronze)
    assert silver.count() == 5                                           # one exact copy removed
    r = {x["Billing Amount"]: x for x in silver.collect()}
    assert r[100.0]["Name"] == "Alice Smith" and r[100.0]["Blood Type"] == "A+" and r[100.0]["Admission Type"] == "URGENT"
    assert r[100.0]["age_group"] == "Middle Aged" and r[9999.99]["age_group"] == "Pediatric"
    assert r[9999.99]["billing_category"] == "Low" and r[None]["billing_category"] == "Very High"
    assert r[100.0]["length_of_stay_days"] == 3
    assert "_row_hash" not in silver.columns and "_silver_record_id" in silver.columns
    assert patients_roles.gold_demographics(silver).count() == 2
    no_gender = silver.drop("Gender")
    assert patients_roles.gold_demographics(no_gender) is None           # skipped when the column is absent


def _trips_raw(spark):
    t = dt.datetime(2024, 1, 1, 8, 0, 0)
    m = dt.timedelta(minutes=1)
    rows = [
        (1, t, t + 30 * m, "N", 1, 10, 20, 1, 12.0, 20.0, 2.0, 22.0, 1, 1, None, None),
        (2, t, t, "Y", None, 10, 30, None, 0.0, 5.0, 0.0, 5.0, 2, 1, 2.5, None),
        (3, t, t - 5 * m, "X", 7, 11, 20, 8, 1.0, -3.0, -1.0, -4.0, 7, 3, 2.5, None),
        (None, None, t, None, 1, 12, 20, 1, 300.0, None, 0.0, 10.0, 1, 1, 0.0, None),
        (1, t + 60 * m, t + 90 * m, "N", 1, 10, 21, 2, 5.0, 600.0, 1.0, 601.0, 1, 2, 0.0, None),
    ]
    schema = ("VendorID int, lpep_pickup_datetime timestamp_ntz, lpep_dropoff_datetime timestamp_ntz, "
              "store_and_fwd_flag string, RatecodeID int, PULocationID int, DOLocationID int, passenger_count int, "
              "trip_distance double, fare_amount double, tip_amount double, total_amount double, payment_type int, "
              "trip_type int, congestion_surcharge double, ehail_fee double")
    return spark.createDataFrame(rows, schema)


def test_trips(spark):
    raw = _trips_raw(spark)
    res = {r.rule_name: r.failed_rows for r in quality.run_rules(raw, trips.dq_rules()).collect()}
    assert len(res) == 19 and all(res[r.name] == raw.filter(r.bad).count() for r in trips.dq_rules())
    assert res["ZERO_duration_trip"] == 1 and res["INVALID_vendor_id"] == 1 and res["EXTREME_passengers"] == 1
    clean, bad = trips.split_trips(raw)
    assert clean.count() == 3 and bad.count() == 2                       # null pickup row is not lost
    silver = trips.silver_trips(clean)
    assert "ehail_fee" not in silver.columns
    s = {r.VendorID: r for r in silver.collect()}
    assert s[2].passenger_count == 1 and s[2].RatecodeID == 1 and s[2].speed_mph is None
    first = silver.filter(F.col("trip_distance") == 12.0).first()
    assert first.trip_duration_minutes == 30.0 and first.speed_mph == 24.0 and first.is_long_trip
    assert first.congestion_surcharge == 0.0 and first.pickup_hour == 8
    daily = trips.gold_daily(silver).collect()
    assert [(r.pickup_date, r.total_trips) for r in daily] == [(dt.date(2024, 1, 1), 3)]
    locs = {(r.location_type, r.location_id): r.trip_count for r in trips.gold_top_locations(silver).collect()}
    assert locs[("pickup", 10)] == 3 and locs[("dropoff", 20)] == 1
    union = trips.gold_top_locations_union(silver)
    assert sorted(union.select("location_type", "location_id", "trip_count").collect()) == \
        sorted(trips.gold_top_locations(silver).select("location_type", "location_id", "trip_count").collect())


def test_study_hidden_sort(spark):
    vals = [(1, 70.0, -0.001), (2, 69.99, -5.0), (3, None, -1.0), (4, 80.0, -0.004), (5, 75.0, 0.0)]
    rows = []
    for job_id, adoption, change in vals:
        r = {c: None for c in study.STUDY_COLUMNS}
        r.update(job_id=job_id, job_role=f"R{job_id % 2}", ai_adoption_level=adoption, salary_change_percent=change)
        rows.append(tuple(r[c] for c in study.STUDY_COLUMNS))
    df = spark.createDataFrame(rows, study.STUDY_SCHEMA)
    out = study.high_adoption_salary_drop(df).collect()
    assert [r.job_id for r in out] == [4, 1]                              # sorted by the unrounded change
    assert [r.salary_change_pct for r in out] == [-0.0, -0.0]
    assert study.distinct_roles(study.high_adoption_salary_drop(df)).first()[0] == 2


def test_gen_patients_domains(spark):
    df = gen_patients(spark.range(2000))
    assert df.count() == 2000 and len(df.columns) == 15
    agg = df.agg(F.min("Age"), F.max("Age"), F.min("Billing Amount"), F.max("Billing Amount"),
                 F.min(F.datediff("Discharge Date", "Date of Admission")),
                 F.max(F.datediff("Discharge Date", "Date of Admission"))).first()
    assert 18 <= agg[0] and agg[1] <= 85 and 1000 <= agg[2] and agg[3] <= 50000 and agg[4] >= 1 and agg[5] <= 30
    assert df.select("Medical Condition").distinct().count() == 6


def _same(a, b, cols):
    return sorted(map(repr, a.select(*cols).collect())) == sorted(map(repr, b.select(*cols).collect()))


def test_places_run_end_to_end(spark):
    from strata.plans.layout import LayerLayout
    from strata.session import scratch_path

    layout = LayerLayout(scratch_path(spark, "test-places-run"))
    report = {(r.layer, r.table_name): (r.row_count, r.removed_rows) for r in
              places.run(spark, _places_raw(spark), layout).collect()}
    assert report[("bronze", "places")] == (7, 0) and report[("silver", "places")] == (2, 5)
    assert report[("quarantine", "places")] == (5, 2)
    gold = spark.read.parquet(layout.spec("gold", "country_summary").target)
    silver, _ = places.split_places(places.silver_places(places.bronze_places(_places_raw(spark))))
    assert _same(gold, places.gold_country_summary(silver), ["country", "poi_count", "pct_of_total"])


def test_patients_runs_end_to_end(spark):
    from strata.plans.layout import LayerLayout
    from strata.session import scratch_path

    csv = scratch_path(spark, "test-patients-run-csv")
    _patients_raw(spark).write.option("header", "true").csv(csv)
    layout = LayerLayout(scratch_path(spark, "test-patients-run"))
    report = {(r.layer, r.table_name): r.row_count for r in patients.run(spark, csv, layout).collect()}
    assert report[("bronze", "patients")] == 5 and report[("silver", "patients")] == 2
    roles = {(r.layer, r.table_name): (r.row_count, r.status) for r in
             patients_roles.run(spark, csv, LayerLayout(scratch_path(spark, "test-roles-run"))).collect()}
    assert roles[("silver", "patients_cleaned")] == (5, "OK") and roles[("gold", "demographics")][1] == "OK"


def test_trips_run_end_to_end(spark):
    from strata.plans.layout import LayerLayout
    from strata.session import scratch_path

    csv = scratch_path(spark, "test-trips-run-csv")
    _trips_raw(spark).write.option("header", "true").csv(csv)
    layout = LayerLayout(scratch_path(spark, "test-trips-run"))
    report = {(r.layer, r.table_name): r.row_count for r in trips.run(spark, csv, layout).collect()}
    assert report[("source", "trips")] == 5 and report[("bronze", "trips")] == 5
    assert report[("quarantine", "trips")] == 2 and report[("silver", "trips")] == 3
    q = spark.read.parquet(layout.spec("quarantine", "trips").target)
    assert set(q.columns) >= {"_quarantine_reason", "_failed_rules", "_ingested_at"}
    daily = spark.read.parquet(layout.spec("gold", "daily").target).first()
    assert daily.total_trips == 3
