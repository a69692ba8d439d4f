"""Streams (6, 7, 57, 74-77) and monitoring (59-63)."""

from __future__ import annotations

import tempfile

from pyspark.sql import functions as F

from recoflow.plans import monitoring
from recoflow.registry import INGEST_EPOCH, active_settings, land
from recoflow.sources import fixtures as fx
from recoflow.sources import stream
from recoflow.streaming import ingest
from tests.conftest import SMALL


def test_stream_equals_batch_form(spark):
    """Op 75 through readStream/foreachBatch equals the static form (52)."""
    base = tempfile.mkdtemp(prefix="stream-")
    fx.stream_event_json(spark, SMALL).repartition(3).write.json(f"{base}/in")
    fx.settings(spark, SMALL).write.parquet(f"{base}/settings")
    src = stream.read_record_stream(spark, f"{base}/in", max_files_per_trigger=1)
    w = ingest.event_batch_writer(lambda: spark.read.parquet(f"{base}/settings"), f"{base}/out",
                                  F.lit(INGEST_EPOCH))
    ingest.run_stream(src, w, f"{base}/ckpt").awaitTermination()
    got = spark.read.parquet(f"{base}/out/records").drop("batch_id")
    want = ingest.event_records(stream.decode_stream_events(fx.stream_event_json(spark, SMALL)),
                                active_settings(spark, SMALL), F.lit(INGEST_EPOCH))
    assert got.count() == want.count() > 0
    assert got.exceptAll(want.select(got.columns)).count() == 0
    counters = spark.read.parquet(f"{base}/out/counters")
    tot = counters.agg(F.sum("success"), F.sum("skip")).first()
    assert tot[0] == want.count()
    assert tot[0] / 4 + tot[1] == fx.read(spark, SMALL, "events").count()


def test_stream_replay_of_a_batch_is_idempotent(spark):
    base = tempfile.mkdtemp(prefix="replay-")
    recs = fx.stream_event_json(spark, SMALL)
    w = ingest.event_batch_writer(lambda: fx.settings(spark, SMALL), f"{base}/out", F.lit(0))
    w(recs, 7)
    w(recs, 7)  # a retried micro-batch overwrites its own folder
    n = spark.read.parquet(f"{base}/out/records").count()
    w2 = ingest.event_records(stream.decode_stream_events(recs), active_settings(spark, SMALL), F.lit(0))
    assert n == w2.count()


def test_upsert_keeps_newest(spark):
    rows = spark.createDataFrame([("r1", 10, "a", "old"), ("r2", 20, "a", "new"), ("r3", 5, "b", "x")],
                                 "record_id string, updated_ts long, itemId string, properties string")
    out = {r.itemId: r.properties for r in ingest.upsert_items(None, rows).collect()}
    assert out == {"a": "new", "b": "x"}


def test_decode_bad_base64_gives_null_fields(spark):
    recs = spark.createDataFrame([("1", "!!notbase64"), ("2", None)], "record_id string, data string")
    out = stream.decode_stream_events(recs).collect()
    assert all(r.sp_event_id is None for r in out)


def test_alarm_needs_consecutive_breaches(spark):
    m = spark.createDataFrame(
        [(0, "PutEventsErrors", 6.0), (1, "PutEventsErrors", 6.0), (300, "PutEventsErrors", 11.0),
         (600, "PutEventsErrors", 12.0), (1200, "PutEventsErrors", 30.0)],
        "ts long, metric string, value double")
    r = monitoring.metric_rollup(m)
    a = monitoring.alarm_rule(r, monitoring.alarm_rules(spark)).orderBy("period").collect()
    assert [(x.period, x.breaching, x.in_alarm) for x in a] == [
        (0, True, False), (300, True, True), (600, True, True), (900, False, True),
        (1200, True, True)]  # no data at 900: passed over


def test_missing_data_ends_a_run_where_the_rule_says_so(spark):
    m = spark.createDataFrame([(0, "m", 5.0), (600, "m", 5.0), (900, "m", 5.0)],
                              "ts long, metric string, value double")
    rules = monitoring.alarm_rules(spark, [("a", "m", "max", 1.0, 2, "notBreaching"),
                                           ("b", "m", "max", 1.0, 2, "missing")])
    out = monitoring.alarm_rule(monitoring.metric_rollup(m), rules).where("in_alarm").collect()
    assert sorted((x.alarm, x.period) for x in out) == [("a", 900), ("b", 600), ("b", 900)]


def test_rollup_percentile_and_coverage_samples(spark):
    cov = spark.createDataFrame([(i, i, 1, 0, 0, i % 2) for i in range(21)],
                                "request_id int, returned long, missing long, missing_metadata long, "
                                "missing_images long, backup long")
    m = monitoring.coverage_samples(cov, F.lit(600))
    got = {r.metric: r for r in monitoring.metric_rollup(m).collect()}
    assert got["ReturnRecommendations"].p95 == 19.0 and got["GetRecommendations"].sum == 21.0
    assert got["ReturnBackupRecommendations"].samples == 10
    assert {r.period for r in got.values()} == {600}


def test_stream_lag_alarm(spark):
    arr = spark.createDataFrame([("e", 0, 12000), ("e", 300000, 300500), ("e", 600000, 611000)],
                                "stream string, event_ms long, arrival_ms long")
    out = monitoring.stream_lag(arr, periods=1).orderBy("period").collect()
    assert [(x.max_lag_ms, x.in_alarm) for x in out] == [(12000, True), (500, False), (11000, True)]


def test_use_rate(spark):
    m = spark.createDataFrame([(10, "GetRecommendations", 1.0)] * 4, "ts long, metric string, value double")
    used = spark.createDataFrame([(0, 1)], "period long, used long")
    r = monitoring.recommendation_use_rate(m, used).first()
    assert r.use_rate == 50.0


def test_item_state_snapshots_are_replay_safe(spark):
    base = tempfile.mkdtemp(prefix="state-")
    recs = fx.stream_content_json(spark, SMALL)
    first, second = recs.filter("cast(record_id as int) % 2 = 0"), recs
    w = ingest.content_batch_writer(lambda: fx.settings(spark, SMALL), f"{base}/out", F.lit(0))
    w(first, 0)
    w(second, 1)
    snap1 = sorted(tuple(r) for r in ingest.items_state(spark, f"{base}/out", 1).collect())
    w(second, 1)  # replay of batch 1 after a failure
    again = sorted(tuple(r) for r in ingest.items_state(spark, f"{base}/out", 1).collect())
    assert snap1 == again and len(snap1) > 0
    n_items = stream.decode_stream_content(recs).filter("ContentId is not null").select(
        "ContentId").distinct().count()
    assert len(snap1) <= n_items


def test_optional_dedupe_drops_redelivered_events(spark):
    base = tempfile.mkdtemp(prefix="dedupe-")
    recs = fx.stream_event_json(spark, SMALL)
    recs.unionAll(recs).repartition(4).write.json(f"{base}/in")  # every event delivered twice
    src = ingest.dedupe_events(stream.read_record_stream(spark, f"{base}/in", 2))
    w = ingest.event_batch_writer(lambda: fx.settings(spark, SMALL), f"{base}/out",
                                  F.lit(INGEST_EPOCH), decoded=True)
    ingest.run_stream(src, w, f"{base}/ckpt").awaitTermination()
    got = spark.read.parquet(f"{base}/out/records").drop("batch_id")
    want = ingest.event_records(stream.decode_stream_events(recs), active_settings(spark, SMALL),
                                F.lit(INGEST_EPOCH))
    assert got.count() == want.count()


def test_landed_files_follow_the_records(spark):
    """What a task writes into a landed file is bounded; small inputs have four files."""
    base = tempfile.mkdtemp(prefix="land-")
    records = spark.range(1000).selectExpr("CAST(id AS STRING) AS record_id", "'x' AS data")
    for most, files in ((1000, 4), (100, 10), (64, 16)):
        land(records, f"{base}/{most}", most)
        sizes = [r["count"] for r in spark.read.json(f"{base}/{most}").groupBy(F.input_file_name()).count().collect()]
        assert len(sizes) == files and sum(sizes) == 1000 and max(sizes) <= 1.5 * 1000 / files
