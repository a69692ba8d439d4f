"""Metric rows from the progress of running streams (op 77, 57).

A ``StreamingQueryListener`` on the driver gets one report per micro-batch and
appends its metrics as JSON lines ``(ts, metric, value)``, the form that
``plans.monitoring`` reads: rows taken in, batch duration, how far the stream
is behind (consumer lag), and every numeric metric observed under the query's
name. Reports are a few numbers a batch, so they are written here,
not by a Spark job.
"""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from recoflow.sources.delivery import open_fs

METRIC_SCHEMA = "ts long, metric string, value double"
OBSERVED = "recoflow_arrivals"


def observe_arrivals(decoded: DataFrame, event_epoch: Column) -> DataFrame:
    """Watch a decoded stream's event times (epoch seconds), in the pass that processes it."""
    return decoded.observe(OBSERVED, F.min(event_epoch).alias("oldest"), F.max(event_epoch).alias("newest"),
                           F.count(F.lit(1)).alias("records"))


def metric_rows(prefix: str, progress: dict) -> list[dict]:
    """Rows of one progress report (its JSON as a dict)."""
    at = datetime.fromisoformat(progress["timestamp"].replace("Z", "+00:00")).astimezone(timezone.utc)
    took = progress.get("durationMs", {}).get("triggerExecution", 0)
    done = at.timestamp() + took / 1000
    rows = {"InputRows": progress.get("numInputRows", 0), "BatchDuration": took}
    seen = (progress.get("observedMetrics") or {}).get(OBSERVED) or {}
    if seen.get("oldest") is not None:  # the age of the batch's oldest record when it was done, ms
        rows["IteratorAge"] = max(0.0, done - seen["oldest"]) * 1000
    if seen.get("records") is not None:
        rows["Records"] = seen["records"]
    return [{"ts": int(done), "metric": prefix + name, "value": float(v)} for name, v in rows.items()]


class MetricsListener(StreamingQueryListener):
    """Appends the metrics of the named queries under ``path``; ``prefixes``: query name -> metric prefix (``PutEvents``)."""

    def __init__(self, path: str, prefixes: dict[str, str]):
        self.path, self.prefixes = path, prefixes

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        prefix = self.prefixes.get(progress.name)
        if prefix is None:
            return
        rows = metric_rows(prefix, json.loads(progress.json))
        store, root = open_fs(self.path)
        store.create_dir(root, recursive=True)
        # a report of the same batch of the same run replaces itself
        name = f"{progress.name}-{progress.runId}-{progress.batchId}"
        with store.open_output_stream(f"{root}/_{name}.tmp") as out:
            out.write("".join(json.dumps(r) + "\n" for r in rows).encode())
        store.move(f"{root}/_{name}.tmp", f"{root}/{name}.json")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(METRIC_SCHEMA).json(path)
