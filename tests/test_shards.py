"""The sharded source: bounded batches, order, restarts that lose and repeat nothing, LATEST start."""

from __future__ import annotations

import json
import tempfile

import pytest
from pyspark.sql import functions as F

from recoflow.sources import fixtures as fx
from recoflow.sources import shards, stream
from recoflow.sources.shards import ShardReader
from tests.conftest import SMALL


def fill(path, shard, n, tag=""):
    at = max((e for _, e, _ in shards.segments(path).get(shard, [])), default=0)
    return shards.append(path, shard, [(f"{shard}-{at + k}{tag}", f"d{at + k}") for k in range(n)])


class Query:
    """A stream from the log into a table of (batch, partition, place, shard, sequence)."""

    def __init__(self, spark, base, fail_at=None, **options):
        self.spark, self.base, self.fail_at = spark, base, fail_at
        src = shards.read_shard_stream(spark, f"{base}/log", f"{base}/ck-shards", **options)

        def write(batch, batch_id):
            if batch_id == self.fail_at:
                raise RuntimeError("lost")
            (batch.select(F.lit(batch_id).alias("batch"), F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place"),
                          "shard", "sequence", "record_id").write.mode("overwrite").parquet(f"{base}/out/batch_id={batch_id}"))
        self.q = src.writeStream.foreachBatch(write).option("checkpointLocation", f"{base}/ck").start()

    def drain(self):
        try:
            self.q.processAllAvailable()
        finally:
            self.q.stop()

    def rows(self):
        return self.spark.read.parquet(f"{self.base}/out").collect()


def check(rows, want: dict[str, tuple[int, int]], size, per_shard):
    """Every record once, in order; partitions and micro-batches within their bounds."""
    seen = {}
    for r in sorted(rows, key=lambda r: (r.batch, r.part, r.place)):
        seen.setdefault(r.shard, []).append(r.sequence)
        assert r.record_id.startswith(f"{r.shard}-{r.sequence}")
    assert seen == {s: list(range(a, b)) for s, (a, b) in want.items() if b > a}
    parts, batches = {}, {}
    for r in rows:
        parts[r.batch, r.part] = parts.get((r.batch, r.part), 0) + 1
        batches[r.batch, r.shard] = batches.get((r.batch, r.shard), 0) + 1
    assert max(parts.values()) <= size and max(batches.values()) <= size * per_shard


def test_bounded_batches_in_order(spark):
    base = tempfile.mkdtemp(prefix="shards-")
    for shard, sizes in (("a", (250, 3, 180)), ("b", (40,)), ("c", (100, 100))):
        for n in sizes:
            fill(f"{base}/log", shard, n)
    q = Query(spark, base, start="earliest")
    q.drain()
    check(q.rows(), {"a": (0, 433), "b": (0, 40), "c": (0, 200)}, 100, 2)
    assert len({r.batch for r in q.rows()}) == 3


def test_latest_start_and_restarts(spark):
    base = tempfile.mkdtemp(prefix="shards-restart-")
    fill(f"{base}/log", "a", 30, "old")
    first = Query(spark, base, records_per_batch=7)
    first.drain()
    assert first.rows() == []  # nothing since the start
    fill(f"{base}/log", "a", 40)
    fill(f"{base}/log", "new", 25)            # a shard that appears later is read whole
    second = Query(spark, base, records_per_batch=7, fail_at=1)
    with pytest.raises(Exception, match="lost"):
        second.drain()
    fill(f"{base}/log", "a", 5)
    third = Query(spark, base, records_per_batch=7)   # does batch 1 again
    third.drain()
    check(third.rows(), {"a": (30, 75), "new": (0, 25)}, 7, 2)
    fill(f"{base}/log", "new", 20)
    fourth = Query(spark, base, records_per_batch=7)  # batch logged and done: goes on after it
    fourth.drain()
    check(fourth.rows(), {"a": (30, 75), "new": (0, 45)}, 7, 2)


def test_the_reader_alone():
    base = tempfile.mkdtemp(prefix="shards-reader-")
    fill(f"{base}/log", "a", 10)
    make = lambda: ShardReader({"path": f"{base}/log", "progress": f"{base}/p", "records_per_batch": "2"})
    r = make()
    start = r.initialOffset()
    assert start == {"a": 10} and r.latestOffset() == {"a": 10}
    fill(f"{base}/log", "a", 9)
    assert make().initialOffset() == {"a": 10}  # stopped before its first batch
    end = r.latestOffset()
    assert end == {"a": 14} == r.latestOffset()
    parts = r.partitions(start, end)
    assert [(p.first, p.end) for p in parts] == [(10, 12), (12, 14)]
    assert [x[1] for p in parts for x in r.read(p)] == [10, 11, 12, 13]
    assert make().latestOffset() == {"a": 18}  # after a restart: goes on from the note
    assert shards.segments(f"{base}/none") == {}


def test_events_through_the_log(spark):
    base = tempfile.mkdtemp(prefix="shards-events-")
    shards.write_log(fx.stream_event_json(spark, SMALL).repartition(3), f"{base}/log", segment=70)
    n = sum(p[-1][1] for p in shards.segments(f"{base}/log").values())
    assert n == fx.read(spark, SMALL, "events").count()
    src = shards.read_shard_stream(spark, f"{base}/log", f"{base}/p", start="earliest")
    q = (stream.decode_stream_events(src).writeStream.format("parquet").option("checkpointLocation", f"{base}/ck")
         .option("path", f"{base}/out").start())
    q.processAllAvailable()
    q.stop()
    got = spark.read.parquet(f"{base}/out")
    want = stream.decode_stream_events(fx.stream_event_json(spark, SMALL))
    assert got.count() == n and got.exceptAll(want).count() == 0
    assert json.load(open(f"{base}/p/planned.json")) == {s: p[-1][1] for s, p in shards.segments(f"{base}/log").items()}


def test_a_larger_log_takes_no_more_micro_batches():
    turns = lambda n: -(-n // shards.shards_for(n)) / (shards.RECORDS_PER_BATCH * shards.BATCHES_PER_SHARD)
    assert shards.shards_for(10) == 16
    assert turns(6_000_000) <= turns(64_000) == 20


def test_a_task_reads_many_batches(spark):
    base = tempfile.mkdtemp(prefix="shards-tasks-")
    for shard, n in (("a", 250), ("b", 40), ("c", 200)):
        fill(f"{base}/log", shard, n)
    r = ShardReader({"path": f"{base}/log", "progress": f"{base}/p", "start": "earliest", "batches_per_task": "3"})
    start = r.initialOffset()
    parts = r.partitions(start, r.latestOffset())
    assert [[(b.shard, b.first, b.end) for b in p.batches] for p in parts] == [
        [("a", 0, 100), ("a", 100, 200), ("b", 0, 40)], [("c", 0, 100), ("c", 100, 200)]]
    q = Query(spark, base, start="earliest", batches_per_task=3)
    q.drain()
    check(q.rows(), {"a": (0, 250), "b": (0, 40), "c": (0, 200)}, 300, 1)
