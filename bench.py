"""Benchmark: headline jobs at one scale factor, one JSON line on stdout.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is forced to completion with the ``noop`` sink (every column
computed, nothing collected to the driver) and timed separately after a
small warm-up on the sf0.001 tables (JVM start-up and code generation are
not part of a job's cost).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "build_interactions",
    "build_items",
    "validate_events",
    "fanout_events",
    "stream_events",
    "similar_items",
    "user_personalization",
    "recommend_batch",
    "reply_assembly",
    "metric_rollup",
    "alarm_rule",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    keys = [k for k in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if k]

    os.environ.setdefault("RECOFLOW_DRIVER_MEMORY", "16g")
    from recoflow.registry import queries
    from recoflow.session import local_session

    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", max(8, int(cpus))))
    spark = local_session(cores=cpus, shuffle_partitions=parts, app="recoflow-bench")
    qs = queries()

    warm = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(warm):
        for k in ("build_interactions", "recommend_batch"):
            qs[k](spark, warm).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    rows: dict[str, int] = {}
    for k in keys:
        t0 = time.perf_counter()
        df = qs[k](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[k] = round(time.perf_counter() - t0, 3)
    for k in ("build_interactions", "recommend_batch"):
        if k in keys:
            rows[k] = qs[k](spark, sf_dir).count()

    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "headline_total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": int(cpus),
        "rows": rows,
        "spark": spark.version,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
