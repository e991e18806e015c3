"""Summarise the executed (final adaptive) physical plan of every catalog
query: shuffles, broadcasts, join strategies, ranking operators, scans.

Usage: python tests/plan_report.py [sf_dir]   -> markdown table on stdout
With PLAN_NO_BROADCAST=1 size-based broadcasts are off (static and
adaptive thresholds -1), which gives the plans Spark picks when the
dimension tables are beyond the threshold, as at 100 TB; explicit
broadcasts of counted results stay.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

NODES = ["Exchange hashpartitioning", "Exchange rangepartitioning", "Exchange SinglePartition",
         "Exchange RoundRobinPartitioning", "BroadcastExchange", "SortMergeJoin", "BroadcastHashJoin",
         "ShuffledHashJoin", "HashAggregate", "WindowGroupLimit", "TakeOrderedAndProject", "FileScan",
         "ReusedExchange"]
SHORT = ["hash-x", "range-x", "single-x", "rr-x", "bcast", "SMJ", "BHJ", "SHJ", "agg", "WGL", "TOP", "scan",
         "reused"]


def summarise(plan: str) -> list[int]:
    return [len(re.findall(re.escape(n), plan)) for n in NODES]


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    from basketry.plans import catalog, catalog_io  # noqa: F401
    from basketry.session import build_session
    spark = build_session("local[8]", shuffle_partitions=16)
    spark.sparkContext.setLogLevel("ERROR")
    if os.environ.get("PLAN_NO_BROADCAST"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    print("| query | " + " | ".join(SHORT) + " |")
    print("| --- |" + " --- |" * len(SHORT))
    only = [q for q in os.environ.get("PLAN_QUERIES", "").split(",") if q]
    for name, fn in catalog.QUERIES.items():
        if only and name not in only:
            continue
        df = fn(spark, sf_dir)
        df._jdf.queryExecution().toRdd().count()  # runs this very plan, so that it becomes final
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        counts = summarise(plan)
        print(f"| `{name}` | " + " | ".join(str(c) if c else "" for c in counts) + " |", flush=True)


if __name__ == "__main__":
    main(sys.argv)
