"""Command-line job runners: the pipeline's jobs over real paths.

    python -m recoflow.jobs interactions --raw-events s3a://.../raw --as-of 2024-01-31 --out ...
    python -m recoflow.jobs items --content ... --as-of ... --out ...
    python -m recoflow.jobs publish --interactions ... --items ... --dest ...
    python -m recoflow.jobs events-stream --records ... --settings ... --sink ... --checkpoint ...
    python -m recoflow.jobs content-stream --records ... --settings ... --sink ... --checkpoint ...
    python -m recoflow.jobs recommend --requests ... --interactions ... --items ... \\
        --metadata ... --images ... --settings ... --as-of ... --out ...
    python -m recoflow.jobs monitor --metrics ... --out ...
    python -m recoflow.jobs alarm-stream --metrics ... --out ... --checkpoint ...

Each runner is a thin argument layer over the package functions; the
session comes from ``spark-submit`` (cluster settings, shared checkpoint
folder) and is only pinned to UTC and AQE here.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from recoflow import schemas
from recoflow.functions import columns
from recoflow.operators import settings as st
from recoflow.operators.validate import split, validate_dataset
from recoflow.plans import etl, monitoring, recommend
from recoflow.session import materialize, prepare
from recoflow.sources import readers, shards, snapshots, stream, writers
from recoflow.streaming import alarms, ingest, progress


def _read(spark: SparkSession, path: str, fmt: str = "parquet"):
    return spark.read.format(fmt).load(path)


def run_interactions(spark, a) -> None:
    raw = spark.read.parquet(a.raw_events)
    keys = [k for k in a.keys.split(",") if k] if a.keys else None
    out = etl.build_interactions(raw, a.as_of, keys=keys, partitions=a.partitions)
    writers.write_interactions(out, a.out, table=a.table)


def run_items(spark, a) -> None:
    out = etl.build_items(readers.scan_content(spark, a.content), a.as_of, partitions=a.partitions)
    writers.write_items(out, a.out)


def run_publish(spark, a) -> None:
    """Both datasets are checked against the import contract; rows that do
    not conform go to ``<dest>/_rejects`` with their reason."""
    version, valid = snapshots.claim_version(spark, a.dest), {}
    for name, path, fields in (("interactions", a.interactions, schemas.INTERACTIONS_FIELDS),
                               ("items", a.items, schemas.ITEMS_FIELDS)):
        rows = writers.read_csv(spark, path, schemas.text_schema(fields))
        valid[name], rejected = split(validate_dataset(rows, fields))
        rejected.write.mode("overwrite").json(f"{a.dest}/_rejects/{name}/v={version}")
    snapshots.publish(spark, valid, a.dest, version=version)
    if a.keep:
        snapshots.retain(spark, a.dest, a.keep)


def _stream_source(spark, a):
    if a.kafka_servers:
        return stream.read_kafka_record_stream(spark, a.kafka_servers, a.records)
    if a.shards:
        return shards.read_shard_stream(spark, a.records, f"{a.checkpoint.rstrip('/')}-shards", a.start)
    return stream.read_record_stream(spark, a.records, a.max_files_per_trigger)


def _watched(spark, a, name: str, decoded, event_time: str):
    """The decoded stream, its progress written as metric rows where ``--metrics-out`` says."""
    if not a.metrics_out:
        return decoded, None
    listener = progress.MetricsListener(a.metrics_out, {name: name})
    spark.streams.addListener(listener)
    return progress.observe_arrivals(decoded, columns.epoch_batch(event_time)), listener


def _drain(spark, a, name: str, records, writer, listener) -> None:
    ingest.run_stream(records, writer, a.checkpoint, available_now=not a.continuous, name=name).awaitTermination()
    if listener:
        spark.streams.removeListener(listener)


def run_events_stream(spark, a) -> None:
    src = _stream_source(spark, a)
    src = ingest.dedupe_events(src, a.dedupe_watermark) if a.dedupe_watermark else stream.decode_stream_events(src)
    src, listener = _watched(spark, a, "PutEvents", src, "sp_derived_tstamp")
    w = ingest.event_batch_writer(lambda: _read(spark, a.settings), a.sink, decoded=True, client=a.client)
    _drain(spark, a, "PutEvents", src, w, listener)


def run_content_stream(spark, a) -> None:
    src, listener = _watched(spark, a, "PutContent", stream.decode_stream_content(_stream_source(spark, a)), "UpdatedDate")
    w = ingest.content_batch_writer(lambda: _read(spark, a.settings), a.sink, initial_state=a.initial_state, decoded=True)
    _drain(spark, a, "PutContent", src, w, listener)


def run_recommend(spark, a) -> None:
    inp = recommend.Inputs(
        requests=_read(spark, a.requests),
        interactions=writers.read_csv(spark, a.interactions, schemas.interactions_csv_schema()),
        items=writers.read_csv(spark, a.items, schemas.items_csv_schema()),
        content_meta=_read(spark, a.metadata), images=_read(spark, a.images),
        settings=_read(spark, a.settings), filters=st.filter_specs(spark))
    rows, req, ranked = recommend.recommend_batch(inp, a.as_of)
    recommend.reply_assembly(rows, req).write.mode("overwrite").json(f"{a.out}/replies")
    coverage = materialize(recommend.coverage_metrics(rows, req, ranked, inp.content_meta, inp.images))
    coverage.write.mode("overwrite").parquet(f"{a.out}/coverage")
    monitoring.coverage_samples(coverage, F.unix_timestamp()).write.mode("overwrite").parquet(
        f"{a.out}/metrics")


def run_monitor(spark, a) -> None:
    """Metric rows from any of: metric tables, the progress of streams, their counters, the events that used a
    recommendation; rolled up, with alarms, TPS and use rate."""
    m = _read(spark, a.metrics).select("ts", "metric", "value")
    for path in a.progress or []:
        m = m.unionByName(progress.read_metrics(spark, path))
    for stream_name, path in (c.split("=", 1) for c in a.counters or []):
        counters = spark.read.parquet(path)
        m = m.unionByName(monitoring.counter_samples(counters, stream_name, F.unix_timestamp(F.col("_metadata.file_modification_time"))))
    if a.used:
        rate = monitoring.recommendation_use_rate(m, monitoring.recommendations_used(_read(spark, a.used)))
        m = m.unionByName(monitoring.use_rate_samples(rate))
    m = materialize(m)
    r = monitoring.metric_rollup(m)
    r.write.mode("overwrite").parquet(f"{a.out}/rollup")
    monitoring.alarm_rule(r, monitoring.alarm_rules(spark)).write.mode("overwrite").parquet(
        f"{a.out}/alarms")
    monitoring.tps(m).write.mode("overwrite").parquet(f"{a.out}/tps")


def run_alarm_stream(spark, a) -> None:
    """Roll-ups and alarms of a running stream of metric rows (JSON files)."""
    src = spark.readStream.schema(progress.METRIC_SCHEMA).json(a.metrics)
    out = alarms.alarm_stream(alarms.rollup_stream(src, a.delay), monitoring.alarm_rules(spark))
    w = out.writeStream.format("parquet").option("path", a.out).option("checkpointLocation", a.checkpoint).outputMode("append")
    (w.trigger(processingTime="1 minute") if a.continuous else w.trigger(availableNow=True)).start().awaitTermination()


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="recoflow.jobs")
    sub = p.add_subparsers(dest="job", required=True)

    j = sub.add_parser("interactions")
    j.add_argument("--raw-events", required=True)
    j.add_argument("--as-of", required=True)
    j.add_argument("--out", required=True)
    j.add_argument("--partitions", type=int)
    j.add_argument("--table")
    j.add_argument("--keys", help="attribute keys, comma-separated (skips key discovery)")
    j.set_defaults(fn=run_interactions)

    j = sub.add_parser("items")
    j.add_argument("--content", required=True)
    j.add_argument("--as-of", required=True)
    j.add_argument("--out", required=True)
    j.add_argument("--partitions", type=int)
    j.set_defaults(fn=run_items)

    j = sub.add_parser("publish")
    j.add_argument("--interactions", required=True)
    j.add_argument("--items", required=True)
    j.add_argument("--dest", required=True)
    j.add_argument("--keep", type=int, help="versions to keep besides those in use; all by default")
    j.set_defaults(fn=run_publish)

    for name, fn in (("events-stream", run_events_stream), ("content-stream", run_content_stream)):
        j = sub.add_parser(name)
        j.add_argument("--records", required=True, help="folder of JSON records, or Kafka topic")
        j.add_argument("--kafka-servers")
        j.add_argument("--shards", action="store_true", help="the records are a sharded log (use with --continuous)")
        j.add_argument("--start", default="latest", choices=("latest", "earliest"))
        j.add_argument("--settings", required=True)
        j.add_argument("--sink", required=True)
        j.add_argument("--checkpoint", required=True)
        j.add_argument("--max-files-per-trigger", type=int, default=100)
        j.add_argument("--continuous", action="store_true")
        j.add_argument("--metrics-out", help="folder for metric rows of the stream's progress")
        if name == "content-stream":
            j.add_argument("--initial-state")
        else:
            j.add_argument("--dedupe-watermark", help="e.g. '1 hour'; off by default")
            j.add_argument("--client", help="deliver to the trackers by this client (module:factory)")
        j.set_defaults(fn=fn)

    j = sub.add_parser("recommend")
    for arg in ("requests", "interactions", "items", "metadata", "images", "settings", "as-of",
                "out"):
        j.add_argument(f"--{arg}", required=True)
    j.set_defaults(fn=run_recommend)

    j = sub.add_parser("monitor")
    j.add_argument("--metrics", required=True)
    j.add_argument("--progress", action="append", help="folder written by --metrics-out of a stream")
    j.add_argument("--counters", action="append", help="<prefix>=<counters folder of a stream's sink>, e.g. PutEvents=...")
    j.add_argument("--used", help="events with ts and page_rid, for the use rate")
    j.add_argument("--out", required=True)
    j.set_defaults(fn=run_monitor)

    j = sub.add_parser("alarm-stream")
    j.add_argument("--metrics", required=True)
    j.add_argument("--out", required=True)
    j.add_argument("--checkpoint", required=True)
    j.add_argument("--delay", default="10 minutes")
    j.add_argument("--continuous", action="store_true")
    j.set_defaults(fn=run_alarm_stream)
    return p


def main(argv=None) -> None:
    args = parser().parse_args(argv)
    spark = prepare(SparkSession.builder.appName(f"recoflow-{args.job}").getOrCreate())
    args.fn(spark, args)


if __name__ == "__main__":
    main()
