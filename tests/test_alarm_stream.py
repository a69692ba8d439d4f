"""Alarms on a stream equal the batch rule on the same rows: runs across micro-batches, silent periods, late rows."""

from __future__ import annotations

import json
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from recoflow.plans import monitoring
from recoflow.streaming import alarms

SCHEMA = "ts long, metric string, value double"
RULES = [("a", "m", "max", 5.0, 3), ("b", "m", "max", 5.0, 3, "notBreaching"), ("c", "m", "sum", 7.0, 1), ("d", "n", "avg", 4.0, 2),
         ("e", "n", "p95", 8.0, 12, "notBreaching"), ("never", "absent", "max", 1.0, 1)]


def write(path, name, rows):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/.{name}", "w") as out:
        out.writelines(json.dumps(dict(zip(("ts", "metric", "value"), r))) + "\n" for r in rows)
    os.rename(f"{path}/.{name}", f"{path}/{name}")


class Run:
    """The stream job over a folder; every ``feed`` is a run of its own from the checkpoint."""

    def __init__(self, spark, rules=RULES, delay="10 minutes"):
        self.spark, self.base, self.n, self.delay = spark, tempfile.mkdtemp(prefix="alarms-"), 0, delay
        self.rules = monitoring.alarm_rules(spark, rules)

    def feed(self, rows):
        write(f"{self.base}/in", f"{self.n:04d}.json", rows)
        self.n += 1
        src = self.spark.readStream.schema(SCHEMA).json(f"{self.base}/in")
        out = alarms.alarm_stream(alarms.rollup_stream(src, self.delay), self.rules)
        q = (out.writeStream.format("parquet").option("checkpointLocation", f"{self.base}/ck").option("path", f"{self.base}/out")
             .outputMode("append").trigger(availableNow=True).start())
        q.awaitTermination()
        return q

    def got(self):
        return sorted(tuple(r) for r in self.spark.read.parquet(f"{self.base}/out").select(
            "alarm", "period", F.round("value", 6), "breaching", "in_alarm").collect())

    def want(self, rows, watermark):
        last = watermark // 300 * 300 - 300
        rollup = monitoring.metric_rollup(self.spark.createDataFrame(rows, SCHEMA)).where(F.col("period") <= last)
        out = monitoring.alarm_rule(rollup, self.rules, until=last)
        return sorted(tuple(r) for r in out.select("alarm", "period", F.round("value", 6), "breaching", "in_alarm").collect())


def test_stream_equals_batch_over_many_runs(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        run, rng, rows, now = Run(spark), random.Random(5), [], 1_000_000
        for k in range(4):
            new = []
            for _ in range(25):
                now += rng.choice([10, 60, 200, 200, 2000])
                late = rng.choice([0, 0, 0, 300, 590])  # within the delay
                new.append((now - late, rng.choice(["m", "m", "n", "other"]), float(rng.randint(0, 9))))
            run.feed(new)
            rows += new
        watermark = max(r[0] for r in rows) - 600
        want = run.want(rows, watermark)
        assert run.got() == want
        assert any(r[4] for r in want) and any(r[2] is None for r in want)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_a_silent_period_ends_a_run_without_an_arriving_row(spark):
    """Metric n goes on, m falls silent: its periods close by timer; rows behind the watermark are dropped."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        run = Run(spark)
        run.feed([(0, "m", 6.0), (300, "m", 6.0), (600, "m", 6.0), (601, "n", 1.0)])
        run.feed([(4000, "n", 1.0)])
        state = {(r[0], r[1]): r[4] for r in run.got()}
        assert state["a", 600] and state["a", 2700]          # missing: keeps its state
        assert state["b", 600] and not state["b", 900]       # not breaching: ended without a row of m
        run.feed([(650, "m", 9.0), (4001, "m", 9.0), (9000, "n", 1.0)])  # the first is too late
        rows = [(0, "m", 6.0), (300, "m", 6.0), (600, "m", 6.0), (601, "n", 1.0), (4000, "n", 1.0), (4001, "m", 9.0), (9000, "n", 1.0)]
        assert run.got() == run.want(rows, 8400)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_unknown_statistics_fail(spark):
    rules = monitoring.alarm_rules(spark, [("a", "m", "p99", 5.0, 3)])
    rollup = monitoring.metric_rollup(spark.createDataFrame([(0, "m", 1.0)], SCHEMA))
    with pytest.raises(Exception, match="unknown statistic p99"):
        monitoring.alarm_rule(rollup, rules).collect()
    with pytest.raises(ValueError, match="unknown statistic p99"):
        alarms.alarm_stream(rollup, rules)


def test_percentile_rules(spark):
    m = spark.createDataFrame([(0, "m", float(v)) for v in range(101)], SCHEMA)
    out = monitoring.alarm_rule(monitoring.metric_rollup(m), monitoring.alarm_rules(spark, [("a", "m", "p95", 95.0, 1), ("b", "m", "p95", 95.1, 1)]))
    assert {r.alarm: r.in_alarm for r in out.collect()} == {"a": True, "b": False}


def test_sketches_merge_to_the_direct_ones_within_their_error(spark):
    rng = random.Random(9)
    rows = [(rng.randrange(0, 7200), "m", rng.choice([rng.random(), rng.gauss(50, 20), 7.0])) for _ in range(60_000)]
    m = spark.createDataFrame(rows, SCHEMA).repartition(6)
    five = monitoring.metric_sketch(m)
    hourly = {r.period: r for r in monitoring.sketch_rollup(monitoring.merge_sketches(five, 3600)).collect()}
    direct = {r.period: r for r in monitoring.sketch_rollup(monitoring.metric_sketch(m, 3600)).collect()}
    exact = {r.period: r for r in monitoring.metric_rollup(m, 3600).collect()}
    assert set(hourly) == set(direct) == set(exact) == {0, 3600}
    for period, e in exact.items():
        values = sorted(v for t, _, v in rows if t // 3600 * 3600 == period)
        for got in (hourly[period], direct[period]):
            assert (got.samples, got.maximum) == (e.samples, e.maximum) and got["sum"] == pytest.approx(e["sum"])
            below, upto = sum(v < got.p95 for v in values), sum(v <= got.p95 for v in values)
            assert below / len(values) - 0.01 <= 0.95 <= upto / len(values) + 0.01
    assert monitoring.sketch_rollup(monitoring.merge_sketches(five.where("false"), 3600)).count() == 0
