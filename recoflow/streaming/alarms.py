"""Metric roll-ups and alarms on a running stream (ops 59, 60, 77).

Samples are rolled up per metric and period by a streaming aggregate (in the
JVM, partial first), which gives a period out when the watermark has passed its
end. Closed periods go to a stateful operator keyed by metric: its state is the
next period and, per alarm, the number of breaches in a row, so runs cross
micro-batches. An event-time timer closes periods in which nothing arrived.
What comes out is ``monitoring.alarm_rule`` with ``until`` at the last closed period.

Samples later than ``delay`` behind the newest are dropped by the watermark; all
others count in their period whenever they arrive.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from recoflow.plans.monitoring import PERIOD, STATISTICS, statistics
from recoflow.session import ship

ALARM_SCHEMA = "alarm string, metric string, period long, value double, breaching boolean, in_alarm boolean"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def rollup_stream(samples: DataFrame, delay: str = "10 minutes", seconds: int = PERIOD) -> DataFrame:
    """59 on a stream of (ts, metric, value): a row per metric and closed period; ``at`` carries the watermark."""
    timed = samples.withColumn("__at", F.timestamp_seconds("ts")).withWatermark("__at", delay)
    closed = timed.groupBy("metric", F.window("__at", f"{seconds} seconds")).agg(*statistics())
    return closed.select("metric", F.unix_timestamp(F.col("window.start")).alias("period"), *STATISTICS.values(), "samples",
                         F.window_time("window").alias("at"))


def step(rules: list[tuple], runs: dict[str, int], period: int, found: dict | None) -> list[tuple]:
    """One period of one metric: alarm rows; ``runs`` (breaches in a row per alarm) moves on."""
    out = []
    for alarm, metric, stat, threshold, periods, missing in rules:
        value = None if found is None else found[STATISTICS[stat]]
        breaching = value is not None and value >= threshold
        if breaching:
            runs[alarm] = runs.get(alarm, 0) + 1
        elif value is not None or missing == "notBreaching":
            runs[alarm] = 0
        out.append((alarm, metric, period, value, breaching, runs.get(alarm, 0) >= periods))
    return out


class AlarmProcessor(StatefulProcessor):
    """Keyed by metric; state: the next period to close, and the run of each alarm."""

    def __init__(self, rules: dict[str, list[tuple]], seconds: int):
        self.rules, self.seconds = rules, seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.next = handle.getValueState("next", "period long")
        self.runs = handle.getMapState("runs", "alarm string", "run long")

    def _load(self) -> tuple[int | None, dict[str, int]]:
        runs = {k[0]: v[0] for k, v in self.runs.iterator()}
        return (self.next.get()[0] if self.next.exists() else None), runs

    def _store(self, following: int, runs: dict[str, int]) -> None:
        self.next.update((following,))
        for alarm, run in runs.items():
            self.runs.updateValue((alarm,), (run,))
        self.handle.registerTimer((following + self.seconds) * 1000)

    def _frames(self, rows: list[tuple]) -> Iterator[pd.DataFrame]:
        if rows:
            out = pd.DataFrame(rows, columns=["alarm", "metric", "period", "value", "breaching", "in_alarm"])
            out["value"] = out["value"].astype("float64")
            yield out

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        rules = self.rules.get(key[0])
        if not rules:
            return
        following, runs = self._load()
        found = {int(r["period"]): r for frame in rows for r in frame.to_dict("records")}
        out = []
        for period in sorted(found):
            while following is not None and following < period:
                out += step(rules, runs, following, None)
                following += self.seconds
            out += step(rules, runs, period, found[period])
            following = period + self.seconds
        if following is not None:
            more, following = self._silent(rules, runs, following, timerValues)
            out += more
            self._store(following, runs)
        yield from self._frames(out)

    def _silent(self, rules: list[tuple], runs: dict[str, int], following: int, timerValues) -> tuple[list[tuple], int]:
        """Close the periods up to the watermark; what the roll-up gave out for them has come."""
        until, out = timerValues.getCurrentWatermarkInMs() // 1000, []
        while following + self.seconds <= until:
            out += step(rules, runs, following, None)
            following += self.seconds
        return out, following

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        following, runs = self._load()
        if following is None:
            return
        out, then = self._silent(self.rules.get(key[0], []), runs, following, timerValues)
        if then > following:
            self._store(then, runs)
        yield from self._frames(out)

    def close(self) -> None:
        pass


def alarm_stream(rollup: DataFrame, rules: DataFrame, seconds: int = PERIOD) -> DataFrame:
    """60 on a stream: ``rollup`` from ``rollup_stream``; ``rules`` as for ``monitoring.alarm_rule`` (a few rows of
    configuration). Metrics without a rule are left out. Write it in append mode."""
    spark = ship(rollup.sparkSession, __name__)
    use_rocksdb(spark)
    by_metric: dict[str, list[tuple]] = {}
    for r in rules.select("alarm", "metric", "stat", "threshold", "periods", "missing").collect():
        if r.stat not in STATISTICS:
            raise ValueError(f"unknown statistic {r.stat}")
        by_metric.setdefault(r.metric, []).append(tuple(r))
    # no filter on the metric here: it would be pushed below the watermark, which all samples move
    return rollup.groupBy("metric").transformWithStateInPandas(
        AlarmProcessor(by_metric, seconds), outputStructType=ALARM_SCHEMA, outputMode="Append", timeMode="EventTime")


def use_rocksdb(spark: SparkSession) -> None:
    """Stateful operators with timers need this state store; a store that the cluster names stays."""
    if "RocksDB" not in spark.conf.get(STATE_STORE, ""):
        spark.conf.set(STATE_STORE, ROCKSDB)
