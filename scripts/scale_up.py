"""Derive a k-times larger copy of a test-table folder (for scaling measurements).

Usage: python scripts/scale_up.py <src_sf_dir> <out_dir> <k>
Each fact table is unioned k times with every key shifted by copy × (max key + 1), so
joins between the copies stay consistent and no copy collides with another; the
fixed-size dimensions (nation, region) are copied as they are. All data is derived
from the given tables by Spark; nothing is synthesised from scratch.
"""

from __future__ import annotations

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import functions as F  # noqa: E402

from strata.session import local_session  # noqa: E402

# table → key columns shifted per copy, grouped by the key domain they share
KEYS = {
    "orders": {"o_orderkey": "order", "o_custkey": "cust"},
    "lineitem": {"l_orderkey": "order", "l_partkey": "part", "l_suppkey": "supp"},
    "customer": {"c_custkey": "cust"},
    "part": {"p_partkey": "part"},
    "supplier": {"s_suppkey": "supp"},
    "events": {"event_id": "event", "user_id": "user"},
}
DOMAIN_SOURCE = {"order": ("orders", "o_orderkey"), "cust": ("customer", "c_custkey"), "part": ("part", "p_partkey"),
                 "supp": ("supplier", "s_suppkey"), "event": ("events", "event_id"), "user": ("events", "user_id")}


def main() -> None:
    src, out, k = sys.argv[1].rstrip("/"), sys.argv[2].rstrip("/"), int(sys.argv[3])
    spark = local_session(8, 16)
    span = {d: spark.read.parquet(f"{src}/{t}.parquet").agg(F.max(c)).first()[0] + 1
            for d, (t, c) in DOMAIN_SOURCE.items()}
    for name in ("nation", "region"):
        spark.read.parquet(f"{src}/{name}.parquet").write.mode("overwrite").parquet(f"{out}/{name}.parquet")
    for table, keys in KEYS.items():
        df = spark.read.parquet(f"{src}/{table}.parquet")
        # one row per (row, copy): explode a per-row copy list (bounded by k), no join
        grown = df.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
        grown = grown.withColumns({c: (F.col(c) + F.col("_copy") * F.lit(span[d])).cast(dict(df.dtypes)[c])
                                   for c, d in keys.items()}).drop("_copy")
        grown.repartition(max(1, k)).write.mode("overwrite").parquet(f"{out}/{table}.parquet")
    print("wrote", out)


if __name__ == "__main__":
    main()
