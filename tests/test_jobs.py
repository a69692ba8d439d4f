"""The command-line jobs run end to end on files."""

from __future__ import annotations

import tempfile

from pyspark.sql import functions as F

from recoflow import jobs, schemas
from recoflow.sources import fixtures as fx
from recoflow.sources import writers
from recoflow.streaming import ingest
from tests.conftest import SMALL


def test_interactions_items_publish_recommend_jobs(spark):
    base = tempfile.mkdtemp(prefix="jobs-")
    fx.raw_events(spark, SMALL).write.partitionBy("year", "month", "day").parquet(f"{base}/raw")
    fx.raw_items(spark, SMALL).write.parquet(f"{base}/content")
    fx.requests(spark, SMALL).write.parquet(f"{base}/requests")
    fx.content_meta(spark, SMALL).write.parquet(f"{base}/meta")
    fx.images(spark, SMALL).write.parquet(f"{base}/images")
    fx.settings(spark, SMALL).write.parquet(f"{base}/settings")
    run = lambda *a: jobs.parser().parse_args(list(a))
    a = run("interactions", "--raw-events", f"{base}/raw", "--as-of", fx.AS_OF, "--out", f"{base}/i")
    a.fn(spark, a)
    a = run("interactions", "--raw-events", f"{base}/raw", "--as-of", fx.AS_OF, "--out",
            f"{base}/i2", "--keys", ",".join(fx.BATCH_ATTRIBUTE_KEYS))
    a.fn(spark, a)
    assert spark.read.csv(f"{base}/i2", header=True).count() == \
        spark.read.csv(f"{base}/i", header=True).count() > 0
    a = run("items", "--content", f"{base}/content", "--as-of", fx.AS_OF, "--out", f"{base}/it")
    a.fn(spark, a)
    bad = writers.read_csv(spark, f"{base}/it", schemas.text_schema(schemas.ITEMS_FIELDS))
    n_items = bad.count()
    writers.write_items(bad.limit(1).withColumn("CREATION_TIMESTAMP", F.lit("soon")), f"{base}/it2")
    a = run("publish", "--interactions", f"{base}/i", "--items", f"{base}/it*", "--dest", f"{base}/p")
    a.fn(spark, a)
    assert [r.skip_reason for r in spark.read.json(f"{base}/p/_rejects/items").collect()] == [
        "missing CREATION_TIMESTAMP"]
    assert writers.current_snapshot(spark, f"{base}/p", "items", schemas.items_csv_schema()).count() == n_items
    a = run("recommend", "--requests", f"{base}/requests", "--interactions", f"{base}/i",
            "--items", f"{base}/it", "--metadata", f"{base}/meta", "--images", f"{base}/images",
            "--settings", f"{base}/settings", "--as-of", fx.AS_OF, "--out", f"{base}/r")
    a.fn(spark, a)
    assert spark.read.json(f"{base}/r/replies").count() == fx.requests(spark, SMALL).count()
    assert spark.read.parquet(f"{base}/r/coverage").count() == fx.requests(spark, SMALL).count()
    a = run("monitor", "--metrics", f"{base}/r/metrics", "--out", f"{base}/rmon")
    a.fn(spark, a)
    seen = {r.metric for r in spark.read.parquet(f"{base}/rmon/rollup").collect()}
    assert {"ReturnRecommendations", "MissingRecommendations"} <= seen


def test_stream_and_monitor_jobs(spark):
    base = tempfile.mkdtemp(prefix="jobs-stream-")
    fx.stream_event_json(spark, SMALL).repartition(2).write.json(f"{base}/ev")
    fx.stream_content_json(spark, SMALL).repartition(2).write.json(f"{base}/ct")
    fx.settings(spark, SMALL).write.parquet(f"{base}/settings")
    fx.metrics_from_events(fx.read(spark, SMALL, "events")).write.parquet(f"{base}/metrics")
    run = lambda *a: jobs.parser().parse_args(list(a))
    a = run("events-stream", "--records", f"{base}/ev", "--settings", f"{base}/settings",
            "--sink", f"{base}/evout", "--checkpoint", f"{base}/evck", "--dedupe-watermark", "1 hour",
            "--metrics-out", f"{base}/progress")
    a.fn(spark, a)
    a = run("content-stream", "--records", f"{base}/ct", "--settings", f"{base}/settings",
            "--sink", f"{base}/ctout", "--checkpoint", f"{base}/ctck", "--metrics-out", f"{base}/progress")
    a.fn(spark, a)
    events = fx.events_flat(spark, SMALL).select("page_rid", F.unix_timestamp(F.col("timestamp").cast("timestamp")).alias("ts"))
    events.write.parquet(f"{base}/used")
    a = run("monitor", "--metrics", f"{base}/metrics", "--progress", f"{base}/progress", "--counters", f"PutEvents={base}/evout/counters",
            "--counters", f"PutContent={base}/ctout/counters", "--used", f"{base}/used", "--out", f"{base}/mon")
    a.fn(spark, a)
    rolled = {r.metric: r for r in spark.read.parquet(f"{base}/mon/rollup").groupBy("metric").agg(
        F.sum("sum").alias("total"), F.max("maximum").alias("most")).collect()}
    n = fx.read(spark, SMALL, "events").count()
    counters = spark.read.parquet(f"{base}/evout/counters").agg(F.sum("success"), F.sum("skip")).first()
    assert (rolled["PutEventsSuccess"].total, rolled["PutEventsSkipped"].total) == counters[:]
    assert rolled["PutEventsRecords"].total == n and rolled["PutEventsInputRows"].total == n
    assert rolled["PutEventsIteratorAge"].most > 10000 and rolled["PutContentIteratorAge"].most > 0
    assert "RecommendationUseRate" in rolled and rolled["PutContentSkipped"].total > 0
    late = spark.read.parquet(f"{base}/mon/alarms").where("alarm = 'ContentIteratorAge' AND in_alarm")
    assert late.count() > 0
    assert spark.read.parquet(f"{base}/evout/records").count() > 0
    assert ingest.items_state(spark, f"{base}/ctout").count() > 0
    assert spark.read.parquet(f"{base}/mon/alarms").count() > 0
