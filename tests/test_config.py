"""Config-driven entry points: IO config files, configured layer paths, catalog tables."""

import json
import uuid

from strata.plans.layout import TableLayout
from strata.plans import copy as copy_flow
from strata.plans import inputs, patients, trains
from strata.session import scratch_path
from strata.sources import sinks
from strata.sources.config import IOConfig

TRAINS_CONFIG = {
    "connection": {"account": "ignored by the reader"},
    "file_paths": {"json": "ainput1/trains"},
    "medallion_paths": {"bronze": "medallion/bronze/exp_trains", "quarantine": "medallion/bronze/exp_trains_quarantine",
                        "silver": "medallion/silver/exp_trains", "gold_route_summary": "medallion/gold/route_summary",
                        "gold_station_frequency": "medallion/gold/station_frequency",
                        "gold_running_days": "medallion/gold/running_days"},
    "output": {"path": "output/exp_trains", "format": "parquet", "mode": "overwrite"},
}


def test_io_config_from_file_and_copy(spark, sf_dir, tmp_path):
    base = scratch_path(spark, "test-config-copy")
    spark.read.parquet(f"{sf_dir}/nation.parquet").write.option("header", "true").csv(f"{base}/in/csv")
    spark.read.parquet(f"{sf_dir}/region.parquet").write.json(f"{base}/in/json")
    spark.read.parquet(f"{sf_dir}/orders.parquet").write.parquet(f"{base}/in/parquet")
    path = tmp_path / "io_config.json"
    path.write_text(json.dumps({"file_paths": {"csv": "in/csv", "json": "in/json", "parquet": "in/parquet"},
                                "output": {"path": "out", "format": "parquet", "mode": "overwrite"}}))
    cfg = IOConfig.from_json(str(path), base)
    assert cfg.output.target == f"{base}/out" and cfg.sources()["csv"] == f"{base}/in/csv"
    rep = {r.name: r.row_count for r in copy_flow.run_from_config(spark, cfg).collect()}
    assert rep["copied"] == rep["parquet"] == spark.read.parquet(f"{sf_dir}/orders.parquet").count() and set(rep) == {*cfg.sources(), "copied"}


def test_trains_run_from_config_uses_configured_paths(spark, sf_dir):
    base = scratch_path(spark, "test-config-trains")
    cfg = IOConfig.from_json(TRAINS_CONFIG, base)
    sinks.write_json_documents(inputs.trains_raw(spark, sf_dir), cfg.sources()["json"], records_per_file=500)
    report = {(r.layer, r.table_name): r.row_count for r in trains.run_from_config(spark, cfg).collect()}
    silver = spark.read.parquet(cfg.layer("silver")).count()
    quarantine = spark.read.parquet(cfg.layer("quarantine")).count()
    assert report[("silver", "stops")] == silver and report[("quarantine", "stops")] == quarantine
    assert silver + quarantine == spark.read.parquet(cfg.layer("bronze")).count()
    assert spark.read.parquet(cfg.layer("gold_running_days")).count() == 7


def test_patients_catalog_tables(spark, sf_dir):
    csv = scratch_path(spark, "test-patients-csv")
    inputs.patients_raw(spark, sf_dir).write.option("header", "true").csv(csv)
    tag = uuid.uuid4().hex[:8]
    layout = TableLayout({"bronze": f"b_{tag}", "silver": f"s_{tag}", "gold": f"g_{tag}"}, location_root=scratch_path(spark, "test-patients-schemas"))
    report = {(r.layer, r.table_name): r.row_count for r in patients.run(spark, csv, layout).collect()}
    assert report["bronze", "patients"] == spark.read.option("header", "true").csv(csv).count()
    assert report["gold", "condition_summary"] == 5
    silver = spark.table(f"s_{tag}.patients")
    assert silver.select(*patients.DEDUP_KEYS).distinct().count() == silver.count()