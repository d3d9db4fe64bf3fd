"""Benchmark: headline strata queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is run to completion with the ``noop`` sink (every row produced,
nothing collected to the driver); one warm-up run, then the median of
$BENCH_REPEATS timed runs. Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from strata.plans import inputs, trains  # noqa: E402
from strata.queries import queries  # noqa: E402
from strata.session import local_session, scratch_path  # noqa: E402
from strata.sources import readers, sinks  # noqa: E402

HEADLINE = [
    "orders_by_status",        # flagship: quality gate + gold summary + share of total
    "dq_rules",                # 19 rules, one pass
    "quarantine_reason",       # rule names per quarantined row
    "null_profile",            # one aggregate + unpivot
    "silver_stops",            # explode + regex cleansing + split
    "gold_route_summary",      # multi-measure group-by incl. distinct count
    "gold_running_days",       # per-train flags + unpivot + frequency
    "gold_country_summary",    # joins to fixed dimensions + pct of total
    "silver_patients",         # top-1 per visit (WindowGroupLimit)
    "gold_hospital_performance",
    "silver_patients_roles",   # hash dedup + role-driven standardisation
    "gold_daily",              # exact decimal averages
    "gold_top_locations",      # stacked single-scan union of two aggregates
    "dedup_top1",
    "agg_count_distinct",
    "profile_describe",
    "study_high_adoption",
    "bronze_write_trains",     # read nested JSON → explode → write bronze (the one step with a published time)
]


def run_once(spark, fn, sf_dir, group: str | None = None) -> float:
    if group:
        spark.sparkContext.setJobGroup(group, group)
    t0 = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    elapsed = time.perf_counter() - t0
    if group:
        spark.sparkContext.setJobGroup("", "")
    return elapsed


def bronze_write_step(spark, sf_dir):
    """The flows' one published timing is "write flattened data to bronze": time exactly that
    step — read multi-line train JSON, explode the routes, write the bronze layer. The JSON is
    landed once beforehand (untimed)."""
    landing = scratch_path(spark, "bench-trains-json")
    sinks.write_json_documents(inputs.trains_raw(spark, sf_dir), landing)
    target = scratch_path(spark, "bench-bronze")

    def step(spark_, _sf):
        bronze = trains.bronze_stops(readers.read_json(spark_, landing, multiline=True, schema=trains.RAW_SCHEMA))
        sinks.write_target(bronze, sinks.SinkSpec(target))
        return readers.read_layer(spark_, target).limit(0)   # the write is the work; nothing more to produce
    return step


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2, app="strata-bench")
    qs = queries()
    qs["bronze_write_trains"] = bronze_write_step(spark, sf_dir)
    times: dict[str, float | None] = {}
    jobs: dict[str, int] = {}
    errors: dict[str, str] = {}
    tracker = spark.sparkContext.statusTracker()
    for key in HEADLINE:
        fn = qs[key]
        try:
            run_once(spark, fn, sf_dir, group=f"bench-{key}")   # warm-up; also counts the Spark jobs of one run
            jobs[key] = len(tracker.getJobIdsForGroup(f"bench-{key}"))
            times[key] = round(statistics.median(run_once(spark, fn, sf_dir) for _ in range(repeats)), 3)
        except Exception as e:  # noqa: BLE001 - report the failure and keep measuring the rest
            times[key] = None
            errors[key] = f"{type(e).__name__}: {str(e)[:200]}"
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    done = [t for t in times.values() if t is not None]
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(done), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                      "cpus": int(cpus), "repeats": repeats, "jobs": jobs, "errors": errors}))


if __name__ == "__main__":
    main()
