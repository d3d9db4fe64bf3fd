"""Print a one-line physical-plan audit per registered query.

Usage: python scripts/plan_audit.py [sf_dir] [key ...]
Counts shuffles and flags operators that do not scale: cartesian / nested-loop
joins, windows without a partition key, sort-based aggregates, Python
evaluation, and driver-side local relations.
"""

from __future__ import annotations

import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from strata.queries import queries  # noqa: E402
from strata.session import local_session  # noqa: E402

FLAGS = {
    "cartesian": r"CartesianProduct",
    "nested_loop": r"BroadcastNestedLoopJoin",
    "window_no_partition": r"Window \[.*\], \[\]",
    "sort_agg": r"SortAggregate",
    "python": r"(BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas)",
    "expand": r"Expand \[",
    "local_relation": r"LocalTableScan",
}


def main():
    args = sys.argv[1:]
    markdown = "--markdown" in args
    args = [a for a in args if a != "--markdown"]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark = local_session(8, 8)
    qs = queries()
    for k in args or sorted(qs):
        try:
            df = qs[k](spark, sf_dir)
            plan = df._jdf.queryExecution().executedPlan().toString()
        except Exception as e:  # noqa: BLE001
            print(f"{k:32s} ERROR {type(e).__name__}")
            continue
        shuffles = len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|RoundRobin|SinglePartition)", plan))
        bcast = plan.count("BroadcastExchange")
        flags = [f for f, pat in FLAGS.items() if re.search(pat, plan)]
        if markdown:
            print(f"| `{k}` | {shuffles} | {bcast} | {', '.join(flags) or '—'} |")
        else:
            print(f"{k:32s} shuffles={shuffles} broadcasts={bcast} {' '.join(flags)}")


if __name__ == "__main__":
    main()
