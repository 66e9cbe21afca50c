"""Print the executed (adaptive, final) physical plan summary of registered queries.

usage: python scripts/plan_summary.py [--sf DIR] name ...

Runs each query once through the DataFrame itself (``collect``, so use it on
queries with modest output) so the adaptive plan is final, then lists the
exchanges, join strategies, window limits and parquet read schemas.
"""

from __future__ import annotations

import argparse
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tastebud.plans.registry import all_queries  # noqa: E402
from tastebud.session import build_session  # noqa: E402

PATTERNS = {
    "shuffle query stages": r"ShuffleQueryStage",
    "broadcast query stages": r"BroadcastQueryStage",
    "reused exchanges": r"ReusedExchange|ReusedQueryStage",
    "sort-merge joins": r"SortMergeJoin",
    "broadcast hash joins": r"BroadcastHashJoin",
    "window group limits": r"WindowGroupLimit",
    "partial hash aggregates": r"HashAggregate\(keys=.*functions=\[partial_",
    "cartesian / nested-loop joins": r"CartesianProduct|BroadcastNestedLoopJoin",
}


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="+")
    a = ap.parse_args()
    spark = build_session()
    qs = all_queries()
    for name in a.names:
        df = qs[name].fn(spark, a.sf)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        print(f"== {name}")
        for label, pat in PATTERNS.items():
            print(f"  {label:32s} {len(re.findall(pat, plan))}")
        for rs in sorted(set(re.findall(r"ReadSchema: (struct<[^>]*>)", plan))):
            print(f"  read schema {rs}")
    spark.stop()


if __name__ == "__main__":
    main()
