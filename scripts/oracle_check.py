"""Run registered queries on Spark and their SQL oracles on DuckDB; compare.

Usage: python scripts/oracle_check.py [sf_dir] [key ...]
Comparison: row count, sorted column names, and the sorted multiset of rows
with every value normalised to text (floats by repr), i.e. exact equality.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

from strata.queries import oracle_sql, queries  # noqa: E402
from strata.session import local_session  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NULL" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    return str(v)


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
                 "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE",
                 "float": "FLOAT", "smallint": "SMALLINT", "tinyint": "TINYINT"}


def type_diff(spark_dtypes, duck_desc):
    duck = {d[0]: str(d[1]) for d in duck_desc}
    return [(c, t, duck.get(c)) for c, t in spark_dtypes
            if SPARK_TO_DUCK.get(t, t.upper()) != (duck.get(c) or "").upper()]


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in rows), sorted(columns)


def main():
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    qs, sqls = queries(), oracle_sql()
    keys = args or sorted(qs)
    spark = local_session(8, 8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    bad = 0
    for k in keys:
        t0 = time.time()
        try:
            sdf = qs[k](spark, sf_dir)
            srows = [tuple(r) for r in sdf.collect()]
            scols = sdf.columns
            sdtypes = sdf.dtypes
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {k}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if k not in sqls:
            print(f"ROWS {k}: {len(srows)} rows (no oracle) {ts:.1f}s")
            continue
        try:
            cur = con.execute(sqls[k])
            dcols = [d[0] for d in cur.description]
            tdiff = type_diff(sdtypes, cur.description)
            drows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {k}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        a, ac = rows_of(scols, srows)
        b, bc = rows_of(dcols, drows)
        if ac != bc:
            print(f"FAIL {k}: columns spark={ac} duckdb={bc}")
            bad += 1
        elif len(a) != len(b):
            print(f"FAIL {k}: rows spark={len(a)} duckdb={len(b)}")
            bad += 1
        elif a != b:
            diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
            print(f"FAIL {k}: values differ ({sum(x != y for x, y in zip(a, b))} rows) e.g. {diff}")
            bad += 1
        elif tdiff:
            print(f"TYPE {k}: values equal, types differ {tdiff[:4]}")
        else:
            print(f"OK   {k}: {len(a)} rows {ts:.1f}s")
    print(f"{len(keys) - bad}/{len(keys)} ok")


if __name__ == "__main__":
    main()
