"""Print, per registered query, the shuffles / broadcasts / sorts in the physical
plan that ran (adaptive execution on) and the columns each scan reads.

    python tools/plan_audit.py [sf_dir] [key ...]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sessionmart import catalog  # noqa: E402
from sessionmart.config import get_session  # noqa: E402


def audit(df) -> dict:
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return {
        "shuffles": len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", plan)),
        "broadcasts": plan.count("BroadcastExchange"),
        "windows": len(re.findall(r"\bWindow\b", plan)),
        "sort_aggs": plan.count("SortAggregate"),
        "scans": sorted(set(re.findall(r"ReadSchema: struct<([^>]*)>", plan))),
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    only = set(sys.argv[2:])
    spark = get_session("local[2]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    for name, fn in catalog.queries().items():
        if only and name not in only:
            continue
        a = audit(fn(spark, sf_dir))
        print(f"{name:26s} shuffles={a['shuffles']} broadcasts={a['broadcasts']} "
              f"windows={a['windows']} sort_aggs={a['sort_aggs']} scans={a['scans']}")
    spark.stop()


if __name__ == "__main__":
    main()
