"""Delivery sink: exact counts with a refusing target, retries, failing tasks."""

from __future__ import annotations

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from recoflow.registry import INGEST_EPOCH
from recoflow.sources import delivery, stream
from recoflow.sources import fixtures as fx
from recoflow.sources.readers import scan_active_settings
from recoflow.operators import settings as st
from recoflow.streaming import ingest
from tests.conftest import SMALL

CLIENT = "recoflow.sources.delivery:RefuseEvery"
SCHEMA = "target string, id long, note string"


def records(spark, n=30):
    return spark.createDataFrame([(t, k, f"é\n{k}") for k in range(n) for t in ("arn:a/1", "b+2 %", "c")], SCHEMA).repartition(5)


def test_a_refusing_target_gives_exact_counts(spark):
    sink = tempfile.mkdtemp(prefix="deliver-")
    out = delivery.deliver(records(spark), sink, 0, "target", "id", CLIENT, {"refuse_every": 3, "refuse_target": "b+2 %"})
    assert {(r.target, r.success, r.fail) for r in out.collect()} == {("arn:a/1", 30, 0), ("b+2 %", 20, 10), ("c", 30, 0)}
    got = {(r.target, r.id, r.note) for r in delivery.delivered(spark, sink, SCHEMA).collect()}
    want = {(r.target, r.id, r.note) for r in records(spark).collect() if r.target != "b+2 %" or r.id % 3}
    assert got == want
    refused = spark.read.json(f"{sink}/_refused/batch_id=0").collect()
    assert sorted(json.loads(r.record)["id"] for r in refused) == list(range(0, 30, 3))
    assert all(r.reason.startswith("b+2 % takes no") for r in refused)
    assert not os.path.exists(f"{sink}/_staging/batch_id=0")


def test_a_retried_batch_delivers_nothing_twice(spark):
    sink = tempfile.mkdtemp(prefix="deliver-retry-")
    for _ in range(2):  # complete: left alone
        delivery.deliver(records(spark), sink, 5, "target", "id", CLIENT, {"refuse_every": 3})
    assert delivery.delivered(spark, sink, SCHEMA).count() == 60
    os.remove(f"{sink}/_outcome/batch_id=5/part.json")  # as if the commit had stopped before its end
    crc = f"{sink}/_outcome/batch_id=5/.part.json.crc"
    if os.path.exists(crc):
        os.remove(crc)
    assert delivery.outcome(spark, sink).count() == 0
    out = delivery.deliver(records(spark).coalesce(2), sink, 5, "target", "id", CLIENT, {"refuse_every": 3})
    assert out.agg(F.sum("success"), F.sum("fail")).first()[:] == (60, 30)
    rows = delivery.delivered(spark, sink, SCHEMA)
    assert rows.count() == rows.distinct().count() == 60
    assert spark.read.json(f"{sink}/_refused/batch_id=5").count() == 30


def test_a_failing_task_publishes_nothing(spark):
    sink = tempfile.mkdtemp(prefix="deliver-fail-")
    broken = records(spark).withColumn("note", F.when((F.col("id") == 29) & (F.col("target") == "c"), F.raise_error(F.lit("lost"))).otherwise(F.col("note")))
    with pytest.raises(Exception, match="lost"):
        delivery.deliver(broken, sink, 1, "target", "id")
    assert not delivery.is_delivered(spark, sink, 1)
    assert [f for f in os.listdir(sink) if not f.startswith("_")] == []
    delivery.deliver(records(spark), sink, 1, "target", "id")
    assert delivery.delivered(spark, sink, SCHEMA).count() == 90


def test_an_empty_batch(spark):
    sink = tempfile.mkdtemp(prefix="deliver-empty-")
    assert delivery.deliver(records(spark).where("false"), sink, 0, "target", "id").count() == 0
    assert delivery.is_delivered(spark, sink, 0) and delivery.delivered(spark, sink, SCHEMA).count() == 0


def test_event_stream_counts_what_targets_refuse(spark):
    base = tempfile.mkdtemp(prefix="deliver-stream-")
    fx.stream_event_json(spark, SMALL).repartition(3).write.json(f"{base}/in")
    active = scan_active_settings(fx.settings(spark, SMALL))
    w = ingest.event_batch_writer(lambda: fx.settings(spark, SMALL), f"{base}/out", F.lit(INGEST_EPOCH),
                                  client=CLIENT, client_options={"refuse_every": 3})
    src = stream.read_record_stream(spark, f"{base}/in", max_files_per_trigger=1)
    ingest.run_stream(src, w, f"{base}/ckpt").awaitTermination()
    records_ = ingest.event_records(stream.decode_stream_events(fx.stream_event_json(spark, SMALL)),
                                    st.targets(active, "eventTrackerId"), F.lit(INGEST_EPOCH))
    third = F.regexp_extract("eventId", "[0-9]+", 0).cast("long") % 3 == 0
    want = records_.agg(F.count_if(~third), F.count_if(third)).first()
    got = spark.read.parquet(f"{base}/out/counters").agg(F.sum("success"), F.sum("fail"), F.sum("skip")).first()
    assert got[:2] == want[:] and want[1] > 0
    n = len(st.targets(active, "eventTrackerId"))
    assert (got[0] + got[1]) // n + got[2] == fx.read(spark, SMALL, "events").count()
    w(fx.stream_event_json(spark, SMALL).limit(5), 0)  # batch 0 again, after it was done: nothing changes
    assert spark.read.parquet(f"{base}/out/counters").agg(F.sum("success"), F.sum("fail"), F.sum("skip")).first() == got


def test_targets_skip_backends_without_one(spark):
    s = spark.createDataFrame([("a", "t2"), ("b", None), ("c", "t1")], "name string, eventTrackerId string")
    assert st.targets(s, "eventTrackerId") == ["t1", "t2"]
