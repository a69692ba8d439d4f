"""Stream ingestion jobs (ops 57, 74, 75, 76).

Each job is ``readStream -> foreachBatch``.  Inside a micro-batch:
decode (6/7) -> validate (41/42) -> build records (20-22) -> fan out to
the active backends (52/53, settings re-read per micro-batch) -> write.

Replays are safe: a micro-batch writes to folders keyed by its
``batch_id`` with ``overwrite``, so a re-run after a failure replaces the
partial output instead of duplicating it; the checkpoint records which
batches are done.  Valid and skipped records (57) are counted with ``observe``
on the same pass that writes the records; with a delivery sink
(``sources/delivery``) success and fail are the targets' own answers. The
content job also keeps the item state (74), see ``item_state``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from recoflow.functions import records as rec
from recoflow.operators import settings as st
from recoflow.operators.validate import split, validate_content, validate_events
from recoflow.session import materialize
from recoflow.sources import delivery
from recoflow.sources.readers import scan_active_settings
from recoflow.sources.stream import decode_stream_content, decode_stream_events
from recoflow.streaming.item_state import ITEM_STATE_COLUMNS, ItemState, upsert_items

__all__ = ["upsert_items", "ITEM_STATE_COLUMNS"]


def ingest_time_now():
    return F.unix_timestamp(F.current_timestamp())


def _events_out(validated: DataFrame, active, ingest_time) -> DataFrame:
    valid, _ = split(validated)
    r = valid.select(rec.event_record(ingest_time).alias("r"))
    flat = r.select(F.col("r.sessionId").alias("sessionId"), F.col("r.userId").alias("userId"),
                    F.col("r.eventList")[0].alias("e")).select("sessionId", "userId", "e.*")
    return st.fanout_events(flat, active)


def _items_out(validated: DataFrame, active, ingest_time) -> DataFrame:
    valid, _ = split(validated)
    r = valid.select(F.col("record_id"), rec.item_record(ingest_time).alias("r"),
                     rec.item_properties(ingest_time)["CREATION_TIMESTAMP"].alias("updated_ts"))
    flat = r.select("record_id", "updated_ts", F.col("r.itemId").alias("itemId"),
                    F.col("r.properties").alias("properties"))
    return st.fanout_items(flat, active)


def event_records(decoded: DataFrame, active: DataFrame, ingest_time=None) -> DataFrame:
    """Valid events -> one flat put-event row per (event, tracker)."""
    ingest_time = ingest_time if ingest_time is not None else ingest_time_now()
    return _events_out(validate_events(decoded), active, ingest_time)


def item_records(decoded: DataFrame, active: DataFrame, ingest_time=None) -> DataFrame:
    """Valid article updates -> one put-item row per (item, dataset)."""
    ingest_time = ingest_time if ingest_time is not None else ingest_time_now()
    return _items_out(validate_content(decoded), active, ingest_time)


def ingest_counters(validated: DataFrame, n_targets, refused: DataFrame | None = None) -> DataFrame:
    """57 (batch form): success (deliveries: valid x targets less the refused ones), fail, skip.

    ``n_targets``: number of targets that records are fanned out to.
    ``refused``: one row per delivery that a target did not take.
    """
    fail = F.lit(0) if refused is None else refused.agg(F.count(F.lit(1))).scalar()
    valid = F.count_if(F.col("skip_reason").isNull())
    return validated.agg(valid.alias("valid"), F.count_if(F.col("skip_reason").isNotNull()).alias("skip")).select(
        (F.col("valid") * n_targets - fail).cast("long").alias("success"), fail.cast("long").alias("fail"),
        F.col("skip").cast("long"))


def observed(validated: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """57 (stream form): valid/skip counts gathered while the batch is written."""
    obs = Observation(name)
    return validated.observe(obs, F.count_if(F.col("skip_reason").isNull()).alias("valid"),
                             F.count_if(F.col("skip_reason").isNotNull()).alias("skip")), obs


def _write_counters(spark: SparkSession, batch_id: int, success: int, fail: int, skip: int, path: str) -> None:
    (spark.createDataFrame([(batch_id, success, fail, skip)], "batch_id long, success long, fail long, skip long")
     .write.mode("overwrite").parquet(path))


def dedupe_events(records: DataFrame, watermark: str = "1 hour") -> DataFrame:
    """Optional redelivery guard for the event stream (default off).

    Delivery is at-least-once; a redelivered event has the same
    ``sp_event_id``.  Decodes the stream, derives the event time and drops
    repeats of an id within the watermark (state per id is kept only for
    the watermark delay, so it stays bounded).  An event without a parsable
    time is timed at its processing time.
    """
    decoded = decode_stream_events(records)
    t = F.try_to_timestamp(F.col("sp_derived_tstamp"))
    timed = decoded.withColumn("__event_time", F.coalesce(t, F.current_timestamp()))
    return (timed.withWatermark("__event_time", watermark)
            .dropDuplicatesWithinWatermark(["sp_event_id"]).drop("__event_time"))


def delivery_path(sink: str) -> str:
    """Where the event stream's delivery sink is."""
    return f"{sink}/delivered"


def _deliver(records: DataFrame, obs: Observation, sink: str, batch_id: int, n_targets: int,
             target: str, key: str, client: str | None, options: dict | None) -> None:
    """Write the records of a batch, to the targets themselves where a client is named, then its counters."""
    spark, out = records.sparkSession, delivery_path(sink)
    counters = f"{sink}/counters/batch_id={batch_id}"
    if client is None:
        records.write.mode("overwrite").parquet(f"{sink}/records/batch_id={batch_id}")
        m = obs.get
        _write_counters(spark, batch_id, int(m["valid"]) * n_targets, 0, int(m["skip"]), counters)
        return
    if delivery.is_delivered(spark, out, batch_id):  # a retry: only the counters may lack
        skip = spark.read.json(f"{sink}/skipped/batch_id={batch_id}").first()["skip"]
    else:
        kept = materialize(records)  # one pass that counts, before anything is delivered
        skip = int(obs.get["skip"])
        (spark.createDataFrame([(skip,)], "skip long").coalesce(1).write.mode("overwrite")
         .json(f"{sink}/skipped/batch_id={batch_id}"))
        delivery.deliver(kept, out, batch_id, target, key, client, options)
    got = delivery.outcome(spark, out, batch_id).agg(
        F.coalesce(F.sum("success"), F.lit(0)).alias("s"), F.coalesce(F.sum("fail"), F.lit(0)).alias("f")).first()
    _write_counters(spark, batch_id, got.s, got.f, skip, counters)


def event_batch_writer(settings_reader: Callable[[], DataFrame], sink: str,
                       ingest_time=None, decoded: bool = False,
                       client: str | None = None, client_options: dict | None = None) -> Callable[[DataFrame, int], None]:
    """foreachBatch body of the event stream (75).  ``decoded``: the stream
    was already decoded upstream (e.g. by ``dedupe_events``). ``client``: delivers
    to the trackers by ``sources/delivery`` instead of writing a table of records."""
    def write(batch: DataFrame, batch_id: int) -> None:
        targets = st.targets(scan_active_settings(settings_at(settings_reader, batch_id)), "eventTrackerId")
        rows = batch if decoded else decode_stream_events(batch)
        validated, obs = observed(validate_events(rows), "events")
        t = ingest_time if ingest_time is not None else ingest_time_now()
        _deliver(_events_out(validated, targets, t), obs, sink, batch_id, len(targets), "trackingId", "eventId",
                 client, client_options)
    return write


def content_batch_writer(settings_reader: Callable[[], DataFrame], sink: str,
                         ingest_time=None, initial_state: str | None = None,
                         decoded: bool = False) -> Callable[[DataFrame, int], None]:
    """foreachBatch body of the content stream (76): records, the item state's
    run of this batch (74) and counters."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        targets = st.targets(scan_active_settings(settings_at(settings_reader, batch_id)), "datasetArn")
        rows = batch if decoded else decode_stream_content(batch)
        validated, obs = observed(validate_content(rows), "content")
        t = ingest_time if ingest_time is not None else ingest_time_now()
        rec_path = f"{sink}/records/batch_id={batch_id}"
        _items_out(validated, targets, t).write.mode("overwrite").parquet(rec_path)
        m = obs.get
        updates = spark.read.parquet(rec_path).select(*ITEM_STATE_COLUMNS)
        ItemState(spark, f"{sink}/state", initial_state).apply(updates, batch_id)
        # last: a batch with counters has its state
        _write_counters(spark, batch_id, int(m["valid"]) * len(targets), 0, int(m["skip"]),
                        f"{sink}/counters/batch_id={batch_id}")
    return write


def settings_at(reader: Callable, batch_id: int) -> DataFrame:
    """The settings for a micro-batch: ``reader(batch_id)`` where it takes one (see
    ``operators/settings_log``), else ``reader()``."""
    return reader(batch_id) if getattr(reader, "by_batch", False) else reader()


def run_stream(records: DataFrame, writer: Callable[[DataFrame, int], None], checkpoint: str,
               available_now: bool = True, processing_time: str | None = None, name: str | None = None):
    """Start the foreachBatch query (``availableNow`` drains what is there); ``name``: as listeners know it."""
    w = records.writeStream.foreachBatch(writer).option("checkpointLocation", checkpoint)
    w = w.queryName(name) if name else w
    w = w.trigger(availableNow=True) if available_now else w.trigger(
        processingTime=processing_time or "10 seconds")
    return w.start()


def items_state(spark: SparkSession, sink: str, batch_id: int | None = None) -> DataFrame:
    """The item state after ``batch_id`` (default: the last complete batch)."""
    return ItemState(spark, f"{sink}/state").read(batch_id)
