"""Checks of sources, sinks and whole flows (round trips through the shared scratch area).

Every check writes derived data of the given tables to a fresh folder under
``spark.checkpoint.dir`` and reads it back with the operator under test.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import quality
from strata.plans import copy as copy_flow
from strata.plans import inputs, patients, patients_roles, places, study, trains, trips
from strata.plans.layout import LayerLayout, TableLayout
from strata.queries import register
from strata.queries.core import DQ_RESULTS_SQL
from strata.queries import ORACLES
from strata.queries.domains import PATIENTS_A_CTE, PATIENTS_B_CTE, TRIPS_CTE
from strata.queries.sqlhelp import PATIENTS_RAW, PLACES_CTE, STUDY_RAW, TRAINS_BRONZE, TRAINS_CTE, TRIPS_RAW
from strata.session import scratch_path
from strata.sources import readers, sinks

# Text formats that keep microseconds through CSV and JSON.
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def T(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return inputs.table(spark, sf, name)


def land_csv(spark: SparkSession, df: DataFrame, name: str, header: bool = True) -> str:
    path = scratch_path(spark, name)
    df.write.mode("overwrite").option("header", str(header).lower()).option("timestampNTZFormat", TS_FORMAT) \
        .option("timestampFormat", TS_FORMAT).option("ignoreLeadingWhiteSpace", "false") \
        .option("ignoreTrailingWhiteSpace", "false").csv(path)
    return path


def cast_like(df: DataFrame, like: DataFrame) -> DataFrame:
    """Cast a read-back frame to the types of the frame that was written."""
    return df.select(*[F.col(c).cast(t).alias(c) for c, t in like.dtypes])


# ------------------------------------------------------------------ scans

@register("scan_generic", "SELECT * FROM customer")
def scan_generic(spark, sf):
    customer = T(spark, sf, "customer")
    path = land_csv(spark, customer, "customer-csv")
    return cast_like(readers.read_file(spark, path, "csv", header="true", inferSchema="true"), customer)


@register("scan_registry", """SELECT 'csv' AS source_format, count(*) AS row_count, count(DISTINCT c_name) AS names FROM customer
UNION ALL SELECT 'json', count(*), count(DISTINCT c_name) FROM customer
UNION ALL SELECT 'parquet', count(*), count(DISTINCT c_name) FROM customer""")
def scan_registry(spark, sf):
    customer = T(spark, sf, "customer")
    root = scratch_path(spark, "registry")
    paths = {fmt: f"{root}/{fmt}" for fmt in ("csv", "json", "parquet")}
    customer.write.option("header", "true").csv(paths["csv"])
    customer.write.json(paths["json"])
    customer.write.parquet(paths["parquet"])
    frames = readers.read_registry(spark, paths)
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct("c_name").alias("names"))
             .select(F.lit(fmt).alias("source_format"), "row_count", "names") for fmt, df in frames.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("scan_csv_infer", TRIPS_RAW)
def scan_csv_infer(spark, sf):
    raw = inputs.trips_raw(spark, sf)
    path = land_csv(spark, raw, "trips-csv")
    read = spark.read.option("header", "true").option("inferSchema", "true") \
        .option("timestampNTZFormat", TS_FORMAT).option("timestampFormat", TS_FORMAT).csv(path)
    return cast_like(read, raw)


def _newline_name(q: str) -> str:
    """Every 97th room's patient name gets a line break (quoted field in CSV); ``q`` quotes identifiers."""
    return f"CASE WHEN {q}Room Number{q} % 97 = 0 THEN concat({q}Name{q}, chr(10), 'jr') ELSE {q}Name{q} END"


@register("scan_csv_multiline", f'SELECT * REPLACE ({_newline_name(chr(34))} AS "Name") FROM ({PATIENTS_RAW})')
def scan_csv_multiline(spark, sf):
    raw = inputs.patients_raw(spark, sf).withColumn("Name", F.expr(_newline_name("`")))
    path = land_csv(spark, raw, "patients-csv")
    read = readers.read_csv(spark, path, infer=True, multiline=True)
    return cast_like(read, raw)


@register("scan_csv_schema", STUDY_RAW)
def scan_csv_schema(spark, sf):
    path = land_csv(spark, inputs.study_raw(spark, sf), "study-csv")
    return readers.read_csv(spark, path, schema=study.STUDY_SCHEMA)


@register("scan_csv_strings", "SELECT cast(o_orderkey AS VARCHAR) AS o_orderkey, cast(o_custkey AS VARCHAR) AS o_custkey, "
                              "o_orderstatus, o_orderpriority FROM orders")
def scan_csv_strings(spark, sf):
    orders = T(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    path = land_csv(spark, orders, "orders-strings")
    return readers.read_csv(spark, path)


def _land_trains_json(spark, sf) -> str:
    path = scratch_path(spark, "trains-json")
    sinks.write_json_documents(inputs.trains_raw(spark, sf), path)
    return path


@register("scan_json_multiline", TRAINS_BRONZE)
def scan_json_multiline(spark, sf):
    raw = readers.read_json(spark, _land_trains_json(spark, sf), multiline=True)
    return trains.bronze_stops(raw)


@register("scan_json_lines", "SELECT * FROM events")
def scan_json_lines(spark, sf):
    events = T(spark, sf, "events")
    path = scratch_path(spark, "events-json")
    events.write.option("timestampNTZFormat", TS_FORMAT).json(path)
    return cast_like(readers.read_json(spark, path), events)


@register("scan_parquet", "SELECT * FROM orders")
def scan_parquet(spark, sf):
    return readers.read_source(spark, readers.SourceSpec(f"{sf.rstrip('/')}/orders.parquet"))


@register("scan_layer_path", "SELECT * FROM customer")
def scan_layer_path(spark, sf):
    spec = LayerLayout(scratch_path(spark, "layers")).spec("bronze", "customer")
    sinks.write_target(T(spark, sf, "customer"), spec)
    return readers.read_layer(spark, spec.target)


def _scratch_schema(spark: SparkSession) -> str:
    name = f"strata_scratch_{uuid.uuid4().hex[:10]}"
    sinks.ensure_schemas(spark, [name], location_root=scratch_path(spark, "catalog"), comment="scratch tables")
    return name


@register("scan_table", "SELECT * FROM customer")
def scan_table(spark, sf):
    fqn = f"{_scratch_schema(spark)}.customer"
    sinks.write_target(T(spark, sf, "customer"), sinks.SinkSpec(fqn, "table"))
    return readers.read_source(spark, readers.SourceSpec(fqn, "table"))


@register("scan_values", f"{DQ_RESULTS_SQL} SELECT * FROM results")
def scan_values(spark, sf):
    results = quality.run_rules(inputs.trips_raw(spark, sf), trips.dq_rules())
    rows = results.collect()  # one row per rule: bounded by the rule list, not by the data
    return spark.createDataFrame(rows, results.schema)


_URGENT_SQL = """
SELECT o_orderstatus, date_trunc('year', o_orderdate) AS order_year, count(*) AS orders,
  count(DISTINCT o_custkey) AS customers, max(o_totalprice) AS largest
FROM {view}
WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
GROUP BY o_orderstatus, date_trunc('year', o_orderdate)
HAVING count(*) > 1"""


@register("sql_view", "SELECT o_orderstatus, strftime(order_year, '%Y-%m-%d') AS order_year, orders, customers, largest FROM ("
                      + _URGENT_SQL.format(view="orders") + ")")
def sql_view(spark, sf):
    view = f"orders_{uuid.uuid4().hex[:10]}"
    T(spark, sf, "orders").createOrReplaceTempView(view)
    return spark.sql(_URGENT_SQL.format(view=view)).withColumn("order_year", F.date_format("order_year", "yyyy-MM-dd"))


@register("file_inventory", "SELECT count(DISTINCT s_nationkey) AS files, true AS has_bytes FROM supplier")
def file_inventory(spark, sf):
    path = scratch_path(spark, "inventory")
    # one file per nation key: hash-partition by the key, then one folder per value
    supplier = T(spark, sf, "supplier")
    supplier.repartition("s_nationkey").write.partitionBy("s_nationkey").parquet(path)
    inv = readers.file_inventory(spark, path, glob="*.parquet")
    return inv.agg(F.count(F.lit(1)).alias("files"), (F.min("length") > 0).alias("has_bytes"))


# ------------------------------------------------------------------ sinks

@register("sink_file", "SELECT * FROM supplier")
def sink_file(spark, sf):
    path = scratch_path(spark, "sink-file")
    sinks.write_file(T(spark, sf, "supplier"), path)
    return readers.read_file(spark, path, sinks.DEFAULT_OUTPUT["format"])


@register("sink_layer", "SELECT * FROM customer")
def sink_layer(spark, sf):
    spec = LayerLayout(scratch_path(spark, "sink-layer")).spec("gold", "customer")
    sinks.write_target(T(spark, sf, "customer"), spec)
    sinks.write_target(T(spark, sf, "customer"), spec)  # overwrite is idempotent
    return readers.read_layer(spark, spec.target)


@register("sink_table", "SELECT * FROM supplier")
def sink_table(spark, sf):
    spec = sinks.SinkSpec(f"{_scratch_schema(spark)}.supplier", "table")
    sinks.write_target(T(spark, sf, "supplier").select("s_suppkey"), spec)
    sinks.write_target(T(spark, sf, "supplier"), spec)  # overwrite replaces the schema
    return sinks.read_target(spark, spec)


@register("gold_write_all", """SELECT 'status_totals' AS name, count(DISTINCT o_orderstatus) AS row_count FROM orders
UNION ALL SELECT 'priority_totals', count(DISTINCT o_orderpriority) FROM orders""")
def gold_write_all(spark, sf):
    o = T(spark, sf, "orders")
    layout = LayerLayout(scratch_path(spark, "gold-all"))
    out = sinks.write_all(spark, {
        "status_totals": (o.groupBy("o_orderstatus").count(), layout.spec("gold", "status_totals")),
        "priority_totals": (o.groupBy("o_orderpriority").count(), layout.spec("gold", "priority_totals")),
        "not_built": (None, layout.spec("gold", "not_built")),
    })
    return out.select("name", "row_count")


@register("verify_readback", """SELECT 'region' AS name, count(*) AS row_count FROM region
UNION ALL SELECT 'nation', count(*) FROM nation UNION ALL SELECT 'orders', count(*) FROM orders""")
def verify_readback(spark, sf):
    layout = LayerLayout(scratch_path(spark, "readback"))
    specs = {n: layout.spec("bronze", n) for n in ("region", "nation", "orders")}
    for n, spec in specs.items():
        sinks.write_counted(T(spark, sf, n), spec)
    return sinks.verify_readback(spark, specs).select("name", "row_count")


@register("ensure_schemas", " UNION ALL ".join(
    f"SELECT '{layer}' AS layer, true AS schema_exists, count(*) AS row_count FROM supplier"
    for layer in ("bronze", "silver", "gold")))
def ensure_schemas(spark, sf):
    names = {layer: f"strata_{layer}_{uuid.uuid4().hex[:8]}" for layer in ("bronze", "silver", "gold")}
    root = scratch_path(spark, "schemas")
    sinks.ensure_schemas(spark, list(names.values()), location_root=root, comment="layer schema")
    sinks.ensure_schemas(spark, list(names.values()), location_root=root)  # idempotent
    listed = {d.name for d in spark.catalog.listDatabases()}
    supplier = T(spark, sf, "supplier")
    parts = []
    for layer, schema in names.items():  # each new schema takes a table, read back through the catalog
        sinks.write_target(supplier, sinks.SinkSpec(f"{schema}.supplier", "table"))
        parts.append(spark.table(f"{schema}.supplier").agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(layer).alias("layer"), F.lit(schema in listed).alias("schema_exists"), "row_count"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("sink_table_strict", "SELECT s_suppkey, s_name FROM supplier")
def sink_table_strict(spark, sf):
    """A table write that must match the existing schema: refused with other columns, done with the same."""
    spec = sinks.SinkSpec(f"{_scratch_schema(spark)}.supplier", "table", keep_schema=True)
    supplier = T(spark, sf, "supplier")
    sinks.write_target(supplier.select("s_suppkey", "s_name").limit(0), spec)
    try:
        sinks.write_target(supplier, spec)
    except ValueError:
        sinks.write_target(supplier.select("s_suppkey", "s_name"), spec)
    return sinks.read_target(spark, spec)


@register("list_schemas", "SELECT true AS listed, 'listed schema' AS description, true AS has_location, count(*) AS row_count FROM region")
def list_schemas(spark, sf):
    name = f"strata_listed_{uuid.uuid4().hex[:8]}"
    sinks.ensure_schemas(spark, [name], location_root=scratch_path(spark, "listed"), comment="listed schema")
    found = sinks.list_schemas(spark).where(F.col("name") == name)
    rows = T(spark, sf, "region").agg(F.count(F.lit(1)).alias("row_count"))
    return found.select(F.lit(True).alias("listed"), "description", F.col("location").contains(name).alias("has_location")).crossJoin(rows)


@register("describe_table", """SELECT column_name AS col_name,
  CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
    WHEN 'VARCHAR' THEN 'string' ELSE lower(data_type) END AS data_type
FROM information_schema.columns WHERE table_name = 'supplier'""")
def describe_table(spark, sf):
    spec = sinks.SinkSpec(f"{_scratch_schema(spark)}.supplier", "table")
    sinks.write_target(T(spark, sf, "supplier"), spec)
    return sinks.describe_table(spark, spec.target)


@register("describe_schema", """SELECT cast(ordinal_position - 1 AS INTEGER) AS position, column_name,
  CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
    WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(data_type) END AS data_type,
  true AS nullable
FROM information_schema.columns WHERE table_name = 'lineitem'""")
def describe_schema(spark, sf):
    return sinks.describe_schema(spark, T(spark, sf, "lineitem"))


# ------------------------------------------------------------------ whole flows


def _report_sql(cte: str, entries: list[tuple[str, str, str]], baseline: str) -> str:
    parts = " UNION ALL ".join(
        f"SELECT '{layer}' AS layer, '{table}' AS table_name, count(*) AS row_count, 'OK' AS status FROM ({q})"
        for layer, table, q in entries)
    base = f"(SELECT count(*) FROM ({baseline}))"
    return (f"{cte}, report AS ({parts}) SELECT *, round(cast(row_count AS double) * 100 / {base}, 1) AS retention_pct, "
            f"{base} - row_count AS removed_rows FROM report")


_TRAINS_DAYS = "SELECT DISTINCT trainNumber FROM trains_silver"


@register("medallion_trains", _report_sql(TRAINS_CTE, [
    ("bronze", "stops", "SELECT * FROM trains_bronze"), ("silver", "stops", "SELECT * FROM trains_silver"),
    ("quarantine", "stops", "SELECT * FROM trains_silver_all EXCEPT ALL SELECT * FROM trains_silver"),
    ("gold", "route_summary", "SELECT DISTINCT trainNumber, trainName, route, origin, destination FROM trains_silver"),
    ("gold", "station_frequency", "SELECT DISTINCT station_name, station_code FROM trains_silver"),
    ("gold", "running_days", "SELECT * FROM (VALUES (1),(2),(3),(4),(5),(6),(7)) WHERE EXISTS (" + _TRAINS_DAYS + ")"),
], "SELECT * FROM trains_bronze"))
def medallion_trains(spark, sf):
    return trains.run(spark, _land_trains_json(spark, sf), LayerLayout(scratch_path(spark, "trains")))


@register("medallion_places", _report_sql(PLACES_CTE, [
    ("bronze", "places", "SELECT * FROM places_raw"), ("silver", "places", "SELECT * FROM places_silver"),
    ("quarantine", "places", "SELECT * FROM places_silver_all EXCEPT ALL SELECT * FROM places_silver"),
    ("gold", "country_summary", "SELECT DISTINCT country FROM places_silver"),
    ("gold", "category_distribution", "SELECT DISTINCT categories FROM places_silver WHERE categories <> ''"),
    ("gold", "city_density", "SELECT DISTINCT city, state, country FROM places_silver WHERE city <> ''"),
], "SELECT * FROM places_raw"))
def medallion_places(spark, sf):
    return places.run(spark, inputs.places_raw(spark, sf), LayerLayout(scratch_path(spark, "places")))


@register("medallion_patients", _report_sql(PATIENTS_B_CTE, [
    ("bronze", "patients", "SELECT * FROM bronze"), ("silver", "patients", "SELECT * FROM silver"),
    ("gold", "condition_summary", "SELECT DISTINCT medical_condition FROM silver"),
    ("gold", "admission_summary", "SELECT DISTINCT admission_type, insurance_provider FROM silver"),
    ("gold", "hospital_performance", "SELECT DISTINCT hospital FROM silver"),
], "SELECT * FROM bronze"))
def medallion_patients(spark, sf):
    path = land_csv(spark, inputs.patients_raw(spark, sf), "patients-b")
    return patients.run(spark, path, LayerLayout(scratch_path(spark, "patients")))


@register("medallion_patients_roles", _report_sql(PATIENTS_A_CTE, [
    ("bronze", "patients_raw", "SELECT * FROM raw"), ("silver", "patients_cleaned", "SELECT * FROM silver"),
    ("gold", "condition_analytics", "SELECT DISTINCT \"Medical Condition\" FROM silver"),
    ("gold", "hospital_metrics", "SELECT DISTINCT \"Hospital\" FROM silver"),
    ("gold", "insurer_revenue", "SELECT DISTINCT \"Insurance Provider\" FROM silver"),
    ("gold", "demographics", "SELECT DISTINCT age_group, \"Gender\" FROM silver"),
], "SELECT * FROM raw"))
def medallion_patients_roles(spark, sf):
    path = land_csv(spark, inputs.patients_raw(spark, sf), "patients-a")
    return patients_roles.run(spark, path, LayerLayout(scratch_path(spark, "patients-roles")))


@register("medallion_trips", _report_sql(TRIPS_CTE, [
    ("source", "trips", "SELECT * FROM raw"), ("bronze", "trips", "SELECT * FROM raw"),
    ("quarantine", "trips", "SELECT * FROM raw EXCEPT ALL SELECT * FROM clean"),
    ("silver", "trips", "SELECT * FROM silver"),
    ("gold", "daily", "SELECT DISTINCT pickup_date FROM silver"),
    ("gold", "hourly", "SELECT DISTINCT pickup_hour FROM silver"),
    ("gold", "top_locations", "SELECT DISTINCT 'p', PULocationID FROM silver UNION ALL "
                              "SELECT DISTINCT 'd', DOLocationID FROM silver"),
], "SELECT * FROM raw"))
def medallion_trips(spark, sf):
    path = land_csv(spark, inputs.trips_raw(spark, sf), "trips-landing")
    return trips.run(spark, path, LayerLayout(scratch_path(spark, "trips")))


@register("medallion_copy", """SELECT 'csv' AS name, count(*) AS row_count FROM nation UNION ALL SELECT 'json', count(*) FROM region
UNION ALL SELECT 'parquet', count(*) FROM lineitem UNION ALL SELECT 'copied', count(*) FROM lineitem""")
def medallion_copy(spark, sf):
    root = scratch_path(spark, "copy-src")
    T(spark, sf, "nation").write.option("header", "true").csv(f"{root}/csv")
    T(spark, sf, "region").write.json(f"{root}/json")
    T(spark, sf, "lineitem").write.parquet(f"{root}/parquet")
    paths = {"csv": f"{root}/csv", "json": f"{root}/json", "parquet": f"{root}/parquet"}
    out = sinks.SinkSpec(scratch_path(spark, "copy-out"))
    return copy_flow.run(spark, paths, out).select("name", "row_count")


# What the flows wrote, against the SQL of the same tables.

@register("medallion_trains_routes", ORACLES["gold_route_summary"])
def medallion_trains_routes(spark, sf):
    layout = LayerLayout(scratch_path(spark, "trains"))
    trains.run(spark, _land_trains_json(spark, sf), layout)
    return sinks.read_target(spark, layout.spec("gold", "route_summary"))


@register("medallion_places_countries", ORACLES["gold_country_summary"])
def medallion_places_countries(spark, sf):
    layout = LayerLayout(scratch_path(spark, "places"))
    places.run(spark, inputs.places_raw(spark, sf), layout)
    return sinks.read_target(spark, layout.spec("gold", "country_summary"))


@register("medallion_patients_tables", ORACLES["gold_hospital_performance"])
def medallion_patients_tables(spark, sf):
    """The flow to catalog tables."""
    names = {layer: f"strata_{layer}_{uuid.uuid4().hex[:8]}" for layer in ("bronze", "silver", "gold")}
    layout = TableLayout(names, location_root=scratch_path(spark, "patients-tables"))
    patients.run(spark, land_csv(spark, inputs.patients_raw(spark, sf), "patients-b"), layout)
    return sinks.read_target(spark, layout.spec("gold", "hospital_performance"))


@register("medallion_patients_roles_hospitals", ORACLES["gold_hospital_metrics"])
def medallion_patients_roles_hospitals(spark, sf):
    layout = LayerLayout(scratch_path(spark, "patients-roles"))
    patients_roles.run(spark, land_csv(spark, inputs.patients_raw(spark, sf), "patients-a"), layout)
    return sinks.read_target(spark, layout.spec("gold", "hospital_metrics")).drop("_gold_processed_at")


def _run_trips(spark, sf) -> LayerLayout:
    layout = LayerLayout(scratch_path(spark, "trips"))
    trips.run(spark, land_csv(spark, inputs.trips_raw(spark, sf), "trips-landing"), layout)
    return layout


@register("medallion_trips_daily", ORACLES["gold_daily"])
def medallion_trips_daily(spark, sf):
    return sinks.read_target(spark, _run_trips(spark, sf).spec("gold", "daily"))


@register("medallion_trips_rules", f"{DQ_RESULTS_SQL} SELECT * FROM results")
def medallion_trips_rules(spark, sf):
    return sinks.read_target(spark, _run_trips(spark, sf).spec("quality", "rule_results"))


# ------------------------------------------------------------------ streaming runners

def _land_trip_files(spark, sf) -> tuple[str, DataFrame]:
    """Trips landed as two parquet drops (morning / afternoon pickups), as files would arrive."""
    raw = inputs.trips_raw(spark, sf)
    landing = scratch_path(spark, "stream-landing")
    early = F.coalesce(F.hour("lpep_dropoff_datetime") < 12, F.lit(True))
    raw.filter(early).write.parquet(f"{landing}/drop=1")
    raw.filter(~early).write.parquet(f"{landing}/drop=2")
    return landing, raw


@register("stream_bronze", f"SELECT *, 'trips' AS _source_file FROM ({TRIPS_RAW})")
def stream_bronze(spark, sf):
    from strata.operators.bronze import audit_columns
    from strata.streaming import stream_layer

    landing, raw = _land_trip_files(spark, sf)
    sink = sinks.SinkSpec(scratch_path(spark, "stream-bronze"))
    source = readers.SourceSpec(f"{landing}/*", "parquet", schema=raw.schema)
    stream_layer(spark, source, lambda df: audit_columns(df, literals={"_source_file": "trips"}), sink,
                 scratch_path(spark, "stream-bronze-checkpoint")).awaitTermination()
    return readers.read_layer(spark, sink.target).drop("_ingested_at")


_TRIPS_BAD_SQL = ("coalesce(fare_amount < 0 OR total_amount < 0 OR trip_distance > 200 "
                  "OR lpep_dropoff_datetime < lpep_pickup_datetime, false)")


@register("stream_quarantine_split", f"SELECT *, NOT {_TRIPS_BAD_SQL} AS is_clean FROM ({TRIPS_RAW})")
def stream_quarantine_split(spark, sf):
    from strata.streaming import stream_split

    landing, raw = _land_trip_files(spark, sf)
    clean = sinks.SinkSpec(scratch_path(spark, "stream-clean"))
    quarantine = sinks.SinkSpec(scratch_path(spark, "stream-quarantine"))
    source = readers.SourceSpec(f"{landing}/*", "parquet", schema=raw.schema)
    stream_split(spark, source, [r.bad for r in trips.critical_rules()], clean, quarantine,
                 scratch_path(spark, "stream-split-checkpoint")).awaitTermination()
    good = readers.read_layer(spark, clean.target).drop("batch_id").withColumn("is_clean", F.lit(True))
    bad = readers.read_layer(spark, quarantine.target).drop("batch_id").withColumn("is_clean", F.lit(False))
    return good.unionByName(bad)
