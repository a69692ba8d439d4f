"""Summarise the physical plans of registered queries (for PLANS.md).

Usage: python scripts/plans.py [sf_dir] key ...

For each key prints the count of shuffles, broadcast exchanges, join
strategies, windows (and window group limits), plus the pushed filters
and read schemas of the Parquet scans.
"""

from __future__ import annotations

import collections
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

OPS = ("ShuffleExchange", "Exchange hashpartitioning", "Exchange rangepartitioning",
       "Exchange RoundRobinPartitioning", "Exchange SinglePartition", "BroadcastExchange",
       "BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin",
       "CartesianProduct", "WindowGroupLimit", "Window ", "HashAggregate", "ObjectHashAggregate",
       "SortAggregate", "Expand", "Generate", "WholeStageCodegen", "BatchEvalPython",
       "ArrowEvalPython")


def summarise(df) -> str:
    plan = df._jdf.queryExecution().executedPlan().toString()
    full = df._jdf.queryExecution().toString()
    counts = collections.Counter()
    for op in OPS:
        counts[op.strip()] = plan.count(op)
    pushed = sorted(set(re.findall(r"PushedFilters: \[[^\]]*\]", full)))
    parts = sorted(set(re.findall(r"PartitionFilters: \[[^\]]*\]", full)))
    schemas = sorted(set(re.findall(r"ReadSchema: struct<[^>]*>", full)))
    lines = [", ".join(f"{k}={v}" for k, v in counts.items() if v)]
    lines += [f"  {p}" for p in parts[:3]] + [f"  {p[:160]}" for p in pushed[:4]]
    lines += [f"  {s[:160]}" for s in schemas[:4]]
    return "\n".join(lines)


def main() -> None:
    args = sys.argv[1:]
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    keys = [a for a in args if not a.startswith("/")]
    from recoflow.registry import queries
    from recoflow.session import local_session
    spark = local_session()
    qs = queries()
    for k in keys or list(qs):
        df = qs[k](spark, sf)
        print(f"### {k}\n{summarise(df)}\n", flush=True)


if __name__ == "__main__":
    main()
