"""Query registry: one callable ``(spark, sf_dir) -> DataFrame`` per operator key.

Each entry derives its domain inputs from the test tables
(``recoflow.sources.fixtures``) and runs one operator or job of the
package over the whole tables, with ``as_of`` fixed to 2024-01-31.
Outputs are scalar columns (arrays joined to text, scores rounded to 6
places) so they compare across engines.
"""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recoflow import schemas
from recoflow.functions import columns as fn
from recoflow.functions import records as rec
from recoflow.operators import candidates as cd
from recoflow.operators import coviews, exploration
from recoflow.operators import filters as flt
from recoflow.operators import projections as pj
from recoflow.operators import scoring, sequences
from recoflow.operators import settings as st
from recoflow.operators import settings_log
from recoflow.operators.validate import split, validate_content, validate_dataset, validate_events
from recoflow.plans import etl, monitoring, recommend
from recoflow.session import ensure_checkpoint_dir, materialize, prepare
from recoflow.sources import fixtures as fx
from recoflow.sources import delivery, readers, shards, snapshots, stream, writers
from recoflow.streaming import alarms, ingest, progress

AS_OF = fx.AS_OF
# Fixed ingest clock for the stream rules' "unparsable time -> now" fallback
# (2024-01-31T00:00:00Z), so static runs are repeatable.
INGEST_EPOCH = 1706659200

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(key: str):
    def deco(fn_: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn_(spark, sf_dir)
        run.__name__ = key
        run.__doc__ = fn_.__doc__
        REGISTRY[key] = run
        return run
    return deco


def queries() -> dict[str, Query]:
    return dict(REGISTRY)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint directory."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/recoflow-{name}-{uuid.uuid4().hex[:12]}"


# -- shared derived inputs -----------------------------------------------------------

def flat_events(spark, sf):
    return fx.events_flat(spark, sf)


def events_with_ts(spark, sf):
    return flat_events(spark, sf).withColumn("TIMESTAMP", fn.epoch_batch("sp_derived_tstamp"))


def interactions(spark, sf, materialized: bool = True):
    """The interactions dataset.  Downstream jobs read it as a stored table
    (the ETL output); here it is derived and materialised once per query
    (callers that materialise a pruned copy themselves pass False)."""
    df = etl.build_interactions(fx.raw_events(spark, sf), AS_OF, keys=fx.BATCH_ATTRIBUTE_KEYS,
                                sort=False)
    return materialize(df) if materialized else df


def mapped_items(spark, sf):
    return pj.apply_mapping(fx.raw_items(spark, sf))


def items(spark, sf):
    return etl.build_items(fx.raw_items(spark, sf), AS_OF, partitions=None)


def decoded_events(spark, sf):
    return stream.decode_stream_events(fx.stream_event_json(spark, sf))


def decoded_content(spark, sf):
    return stream.decode_stream_content(fx.stream_content_json(spark, sf))


def active_settings(spark, sf):
    return readers.scan_active_settings(fx.settings(spark, sf))


def resolved_requests(spark, sf):
    return recommend.resolve_request(fx.requests(spark, sf), fx.settings(spark, sf),
                                     st.filter_specs(spark), AS_OF)


def history_candidates(spark, sf):
    """Per request: the items its visitor ever touched in the month
    (request_id, user_id, item_id, category) — a bounded candidate list
    for the filter and join operators."""
    req = resolved_requests(spark, sf).select(
        "request_id", F.col("visitor_id").alias("user_id"),
        fn.resolve_category().alias("category"), "last_content_ids")
    touched = (etl.to_interactions(flat_events(spark, sf))
               .select(F.col("USER_ID").alias("user_id"), F.col("ITEM_ID").alias("item_id"))
               .filter(F.col("item_id").isNotNull()).distinct())
    return req.join(touched, "user_id")


def r6(c):
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


# -- 2.1 scans, sources, sinks ---------------------------------------------------------

@register("scan_rolling_month")
def q_scan_rolling_month(spark, sf):
    """1: rolling month ending 2024-01-20 over the date partitions."""
    return (readers.scan_rolling_month(fx.raw_events(spark, sf), "2024-01-20")
            .select("eventdate", "timestamp", "year", "month", "day"))


@register("scan_content")
def q_scan_content(spark, sf):
    """2: content metadata as read from the catalog."""
    path = scratch(spark, "content")
    fx.raw_items(spark, sf).write.parquet(path)
    return readers.scan_content(spark, path).select(
        "contentid", "category", "section", "contenttext", "publisheddate", "wordcount",
        "sponsored", F.array_join("keywords", "|").alias("keywords"))


@register("write_interactions")
def q_write_interactions(spark, sf):
    """3: interactions written as CSV and read back."""
    path = writers.write_interactions(interactions(spark, sf, materialized=False), scratch(spark, "interactions"))
    return writers.read_csv(spark, path, schemas.interactions_csv_schema())


@register("write_items")
def q_write_items(spark, sf):
    """4: items written as CSV (text with newlines and quotes) and read back."""
    path = writers.write_items(items(spark, sf), scratch(spark, "items"))
    return writers.read_csv(spark, path, schemas.items_csv_schema())


@register("refresh_snapshot")
def q_refresh_snapshot(spark, sf):
    """5: publish both datasets twice, the first time half of them; read both back from one version, checked."""
    dest = scratch(spark, "snapshot")
    inter, it = interactions(spark, sf, materialized=False), items(spark, sf)
    snapshots.publish(spark, {"interactions": inter.where("length(USER_ID) % 2 = 0"), "items": it}, dest)
    snapshots.publish(spark, {"interactions": inter, "items": it}, dest)
    got = snapshots.read(spark, dest, {"interactions": schemas.interactions_csv_schema(), "items": schemas.items_csv_schema()})
    count = lambda name: got[name].agg(F.count(F.lit(1)).alias("rows")).withColumn("dataset", F.lit(name))
    return count("interactions").unionByName(count("items"))


@register("dataset_flags")
def q_dataset_flags(spark, sf):
    """10: the fields of both datasets with their flags, after checks, a write and a read; and how many rows pass."""
    base, out = scratch(spark, "flags"), None
    for name, rows, schema in (("interactions", interactions(spark, sf, materialized=False), schemas.INTERACTIONS),
                               ("items", etl.to_items(mapped_items(spark, sf)), schemas.ITEMS)):
        valid, _ = split(validate_dataset(rows, schema))
        valid.write.parquet(f"{base}/{name}")
        back = spark.read.parquet(f"{base}/{name}")
        fields = F.inline(F.array(*(F.struct(F.lit(f.name).alias("field"), F.lit(f.dataType.simpleString()).alias("type"),
                                             F.lit(schemas.flag_of(f)).alias("flag")) for f in back.schema.fields)))
        part = back.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("dataset"), "n", fields)
        out = part if out is None else out.unionByName(part)
    return out


@register("validate_interactions")
def q_validate_interactions(spark, sf):
    """10: raw click rows against the interactions' schema (users and items may lack)."""
    rows = etl.to_interactions(flat_events(spark, sf))
    return validate_dataset(rows, schemas.INTERACTIONS)


@register("decode_stream_events")
def q_decode_stream_events(spark, sf):
    """6: base64 JSON event records decoded."""
    return decoded_events(spark, sf)


@register("shard_stream")
def q_shard_stream(spark, sf):
    """6: the events as a sharded log, read from its first record in batches of 100, two a shard."""
    base = scratch(spark, "shards")
    records = fx.stream_event_json(spark, sf)
    shards.write_log(records.repartition(shards.shards_for(records.count())), f"{base}/log")
    src = shards.read_shard_stream(spark, f"{base}/log", f"{base}/ck-shards", start="earliest", batches_per_task=32)
    q = stream.decode_stream_events(src).writeStream.format("parquet").option("path", f"{base}/out").option(
        "checkpointLocation", f"{base}/ck").start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return spark.read.parquet(f"{base}/out")


@register("decode_stream_content")
def q_decode_stream_content(spark, sf):
    """7: base64 JSON article records decoded."""
    d = decoded_content(spark, sf)
    return d.withColumn("Keywords", F.array_join("Keywords", "|"))


@register("scan_active_settings")
def q_scan_active_settings(spark, sf):
    """9: active backends."""
    return active_settings(spark, sf).drop("backend_order")


@register("validate_dataset")
def q_validate_dataset(spark, sf):
    """10: item rows conformed to the items schema with a reject reason."""
    rows = etl.to_items(mapped_items(spark, sf))
    return validate_dataset(rows, schemas.ITEMS_FIELDS)


# -- 2.2 projections and scalar functions -------------------------------------------------

@register("pivot_attributes")
def q_pivot_attributes(spark, sf):
    """11: attribute map pivoted to columns (keys discovered from data)."""
    return pj.pivot_attributes(fx.raw_events(spark, sf))


@register("apply_mapping")
def q_apply_mapping(spark, sf):
    """12: rename + cast of the content columns."""
    return mapped_items(spark, sf).withColumn("Keywords", F.array_join("Keywords", "|"))


@register("resolve_user_batch")
def q_resolve_user_batch(spark, sf):
    return flat_events(spark, sf).select("sp_event_id", fn.resolve_user_batch().alias("USER_ID"))


@register("resolve_user_stream")
def q_resolve_user_stream(spark, sf):
    return flat_events(spark, sf).select("sp_event_id", fn.resolve_user_stream().alias("userId"))


@register("epoch_batch")
def q_epoch_batch(spark, sf):
    return flat_events(spark, sf).select(
        "sp_event_id", "sp_derived_tstamp", fn.epoch_batch("sp_derived_tstamp").alias("TIMESTAMP"))


@register("epoch_stream")
def q_epoch_stream(spark, sf):
    return flat_events(spark, sf).select(
        "sp_event_id", fn.epoch_stream("sp_derived_tstamp", F.lit(INGEST_EPOCH)).alias("sentAt"))


@register("exclude_flag_batch")
def q_exclude_flag_batch(spark, sf):
    return mapped_items(spark, sf).select("ITEM_ID", fn.exclude_flag_batch().alias("Exclude"))


@register("exclude_flag_stream")
def q_exclude_flag_stream(spark, sf):
    return fx.content_flat(spark, sf).select("doc_id", fn.exclude_flag_stream().alias("Exclude"))


@register("truncate_text")
def q_truncate_text(spark, sf):
    t = fn.truncate_text("ContentText")
    return fx.content_flat(spark, sf).select("doc_id", t.alias("ContentText"),
                                             F.length(t).alias("n_chars"))


@register("event_record")
def q_event_record(spark, sf):
    valid, _ = split(validate_events(decoded_events(spark, sf)))
    return valid.select("sp_event_id",
                        F.to_json(rec.event_record(F.lit(INGEST_EPOCH))).alias("record"))


@register("event_properties_json")
def q_event_properties_json(spark, sf):
    return decoded_events(spark, sf).select("sp_event_id",
                                            rec.event_properties_json().alias("properties"))


@register("item_record")
def q_item_record(spark, sf):
    valid, _ = split(validate_content(decoded_content(spark, sf)))
    r = valid.select("record_id", rec.item_record(F.lit(INGEST_EPOCH)).alias("r"))
    return r.select("record_id", "r.itemId", "r.properties")


@register("parse_request")
def q_parse_request(spark, sf):
    return recommend.parse_request(fx.requests(spark, sf))


@register("resolve_category")
def q_resolve_category(spark, sf):
    p = recommend.parse_request(fx.requests(spark, sf))
    return p.select("request_id", fn.resolve_category().alias("category"))


@register("user_context")
def q_user_context(spark, sf):
    p = recommend.parse_request(fx.requests(spark, sf))
    return p.select("request_id", fn.capitalize("platform").alias("ctx_platform"),
                    fn.capitalize("visitor_type").alias("ctx_visitor_type"))


@register("rename_fields")
def q_rename_fields(spark, sf):
    r = pj.rename_fields(fx.content_meta(spark, sf).drop("doc_id", "Byline", "Keywords",
                                                           "WordCount"))
    return r


@register("join_byline")
def q_join_byline(spark, sf):
    return fx.content_meta(spark, sf).select(F.col("ContentId").alias("content_id"),
                                             fn.join_byline("Byline").alias("byline"))


@register("image_urls")
def q_image_urls(spark, sf):
    return recommend.image_fields(fx.images(spark, sf)).drop("has_images")


@register("decimal_to_number")
def q_decimal_to_number(spark, sf):
    d = pj.decimal_to_number(fx.content_meta(spark, sf).select("ContentId", "WordCount"))
    return d.select("ContentId", F.to_json("WordCount").alias("WordCount"))


@register("dated_filter_name")
def q_dated_filter_name(spark, sf):
    ctx = st.context_entries(st.build_context_map(active_settings(spark, sf),
                                                  st.filter_specs(spark)))
    return ctx.select("name", "context",
                      fn.dated_filter_name("filter_name", AS_OF).alias("dated_filter_name"))


# -- 2.3 filters and predicates -------------------------------------------------------------

@register("recent_interactions")
def q_recent_interactions(spark, sf):
    return flt.recent_interactions(events_with_ts(spark, sf), AS_OF).select("sp_event_id",
                                                                             "TIMESTAMP")


@register("recent_items")
def q_recent_items(spark, sf):
    return flt.recent_items(etl.to_items(mapped_items(spark, sf)), AS_OF).select(
        "ITEM_ID", "CREATION_TIMESTAMP")


@register("page_view_filters")
def q_page_view_filters(spark, sf):
    return flt.page_view_filters(flat_events(spark, sf)).select(
        "sp_event_id", "sp_app_id", "sp_event_name", "page_type")


@register("content_id_filters")
def q_content_id_filters(spark, sf):
    return flt.content_id_filters(flat_events(spark, sf)).select("sp_event_id", "content_contentid")


@register("bot_filter")
def q_bot_filter(spark, sf):
    return flt.bot_filter(flat_events(spark, sf)).select("sp_event_id",
                                                         "device_detector_visitorplatform")


@register("premium_filter")
def q_premium_filter(spark, sf):
    return flt.premium_filter(flat_events(spark, sf)).select("sp_event_id", "visitor_servicecode")


@register("isp_denylist")
def q_isp_denylist(spark, sf):
    return flt.isp_denylist(flat_events(spark, sf)).select("sp_event_id", "sp_ip_isp")


@register("host_denylist")
def q_host_denylist(spark, sf):
    return flt.host_denylist(flat_events(spark, sf)).select("sp_event_id", "sp_page_urlhost")


@register("drop_incomplete_interactions")
def q_drop_incomplete_interactions(spark, sf):
    return flt.drop_incomplete_interactions(etl.to_interactions(flat_events(spark, sf)))


@register("drop_incomplete_items")
def q_drop_incomplete_items(spark, sf):
    return flt.drop_incomplete_items(etl.to_items(mapped_items(spark, sf)))


@register("validate_events")
def q_validate_events(spark, sf):
    return validate_events(decoded_events(spark, sf)).select("sp_event_id", "skip_reason")


@register("validate_content")
def q_validate_content(spark, sf):
    return validate_content(decoded_content(spark, sf)).select("record_id", "skip_reason")


def _filtered(spark, sf, fn_):
    c = fn_(history_candidates(spark, sf), items(spark, sf), interactions(spark, sf))
    return c.select("request_id", "item_id")


@register("item_filter_category")
def q_item_filter_category(spark, sf):
    return _filtered(spark, sf, cd.item_filter_category)


@register("item_filter_unread")
def q_item_filter_unread(spark, sf):
    return _filtered(spark, sf, cd.item_filter_unread)


@register("item_filter_exclcat")
def q_item_filter_exclcat(spark, sf):
    return _filtered(spark, sf, cd.item_filter_exclcat)


@register("item_filter_age")
def q_item_filter_age(spark, sf):
    i = cd.item_attributes(items(spark, sf))
    return i.filter(cd.passes_age(AS_OF)).select("item_id", "item_created")


@register("time_range_rule")
def q_time_range_rule(spark, sf):
    return resolved_requests(spark, sf).select("request_id", "kind", "category", "dated")


@register("drop_last_content")
def q_drop_last_content(spark, sf):
    c = history_candidates(spark, sf)
    return flt.drop_last_content(c, "item_id", "last_content_ids").select("request_id", "item_id")


# -- 2.4 joins -------------------------------------------------------------------------------

@register("enrich_metadata")
def q_enrich_metadata(spark, sf):
    c = history_candidates(spark, sf).select("request_id", "item_id")
    return recommend.enrich_metadata(c, fx.content_meta(spark, sf)).select(
        "request_id", "item_id", "title", "byline", "url", "section_meta_title",
        F.col("word_count").cast("double").alias("word_count"))


@register("enrich_images")
def q_enrich_images(spark, sf):
    c = history_candidates(spark, sf).select("request_id", "item_id")
    return recommend.enrich_images(c, fx.images(spark, sf)).select(
        "request_id", "item_id", "author_url220", "picture_url220", F.coalesce("has_images", F.lit(False)).alias("has_images"))


@register("exclude_viewed")
def q_exclude_viewed(spark, sf):
    c = history_candidates(spark, sf)
    return cd.exclude_viewed(c, interactions(spark, sf)).select("request_id", "item_id")


@register("fanout_events")
def q_fanout_events(spark, sf):
    return ingest.event_records(decoded_events(spark, sf), active_settings(spark, sf),
                                F.lit(INGEST_EPOCH))


@register("fanout_items")
def q_fanout_items(spark, sf):
    return ingest.item_records(decoded_content(spark, sf), active_settings(spark, sf),
                               F.lit(INGEST_EPOCH))


@register("settings_as_of")
def q_settings_as_of(spark, sf):
    """52 by version: valid events to the trackers that were active at their time. The settings have three
    versions: as given, without the first active tracker from the 11th on, all active from the 21st on."""
    log, now = settings_log.SettingsLog(spark, scratch(spark, "settings")), fx.settings(spark, sf)
    first = st.targets(readers.scan_active_settings(now), "eventTrackerId")[0]
    day = lambda d: 1704067200 + (d - 1) * 86400  # noqa: E731 - a day of January 2024
    log.append(now, 0)
    log.append(now.withColumn("status", F.when(F.col("eventTrackerId") == first, "retired").otherwise(F.col("status"))), day(11))
    log.append(now.withColumn("status", F.lit("active")), day(21))
    valid, _ = split(validate_events(decoded_events(spark, sf)))
    events = valid.select("sp_event_id", fn.epoch_batch("sp_derived_tstamp").alias("happened"))
    return settings_log.fanout_as_of(events, log, "happened", "eventTrackerId", "trackingId")


@register("context_lookup")
def q_context_lookup(spark, sf):
    return resolved_requests(spark, sf).select("request_id", "backend", "filter_name", "kind")


@register("assign_backend")
def q_assign_backend(spark, sf):
    p = recommend.parse_request(fx.requests(spark, sf))
    return st.assign_backend(p, active_settings(spark, sf)).select("request_id", "backend")


# -- 2.5 aggregations and metrics ---------------------------------------------------------

@register("distinct_attribute_keys")
def q_distinct_attribute_keys(spark, sf):
    return pj.distinct_attribute_keys(fx.raw_events(spark, sf))


@register("ingest_counters")
def q_ingest_counters(spark, sf):
    n = active_settings(spark, sf).count()
    ev = ingest.ingest_counters(validate_events(decoded_events(spark, sf)), n)
    ct = ingest.ingest_counters(validate_content(decoded_content(spark, sf)), n)
    return (ev.withColumn("stream", F.lit("events"))
            .unionByName(ct.withColumn("stream", F.lit("content"))))


def _recommend(spark, sf):
    inp = recommend.Inputs(
        requests=fx.requests(spark, sf), interactions=interactions(spark, sf, materialized=False),
        items=items(spark, sf), content_meta=fx.content_meta(spark, sf),
        images=fx.images(spark, sf), settings=fx.settings(spark, sf),
        filters=st.filter_specs(spark))
    return inp, recommend.recommend_batch(inp, AS_OF)


@register("coverage_metrics")
def q_coverage_metrics(spark, sf):
    inp, (rows, req, ranked) = _recommend(spark, sf)
    return recommend.coverage_metrics(rows, req, ranked, inp.content_meta, inp.images)


def metrics_table(spark, sf):
    ev = fx.read(spark, sf, "events")
    return fx.metrics_from_events(ev)


@register("metric_rollup")
def q_metric_rollup(spark, sf):
    r = monitoring.metric_rollup(metrics_table(spark, sf))
    return r.select("metric", "period", r6("sum").alias("sum"), r6("maximum").alias("maximum"),
                    r6("average").alias("average"), r6("p95").alias("p95"), "samples")


@register("alarm_rule")
def q_alarm_rule(spark, sf):
    r = monitoring.metric_rollup(metrics_table(spark, sf))
    a = monitoring.alarm_rule(r, monitoring.alarm_rules(spark))
    return a.select("alarm", "period", r6("value").alias("value"), "breaching", "in_alarm")


@register("stream_alarms")
def q_stream_alarms(spark, sf):
    """59, 60 on a stream: the samples in three runs of the stream, each a third of the time; the alarms
    of all periods that the watermark closed."""
    base, m = scratch(spark, "stream-alarms"), metrics_table(spark, sf)
    lo, hi = m.agg(F.min("ts"), F.max("ts")).first()
    rules = monitoring.alarm_rules(spark)
    for k in range(3):
        part = m.where((F.col("ts") >= lo + (hi + 1 - lo) * k // 3) & (F.col("ts") < lo + (hi + 1 - lo) * (k + 1) // 3))
        part.write.mode("append").json(f"{base}/in")
        src = spark.readStream.schema(progress.METRIC_SCHEMA).json(f"{base}/in")
        out = alarms.alarm_stream(alarms.rollup_stream(src), rules)
        out.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/ck").outputMode(
            "append").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(alarms.ALARM_SCHEMA).parquet(f"{base}/out").select(
        "alarm", "period", r6("value").alias("value"), "breaching", "in_alarm")


@register("metric_sketch")
def q_metric_sketch(spark, sf):
    """59 by sketches: hourly rows merged from 5-minute ones; ``p95_within``: the sketch's 95th percentile
    has a rank within 1.33 % among all samples of its hour."""
    m = metrics_table(spark, sf)
    hourly = monitoring.sketch_rollup(monitoring.merge_sketches(monitoring.metric_sketch(m), 3600))
    ranked = m.withColumn("period", monitoring.period_start("ts", 3600)).join(hourly.select("metric", "period", "p95"), ["metric", "period"])
    ranks = ranked.groupBy("metric", "period").agg((F.count_if(F.col("value") < F.col("p95")) / F.count(F.lit(1))).alias("below"),
                                                   (F.count_if(F.col("value") <= F.col("p95")) / F.count(F.lit(1))).alias("upto"))
    return hourly.join(ranks, ["metric", "period"]).select(
        "metric", "period", r6("sum").alias("sum"), r6("maximum").alias("maximum"), r6("average").alias("average"), "samples",
        ((F.col("below") <= 0.95 + 0.0133) & (F.col("upto") >= 0.95 - 0.0133)).alias("p95_within"))


@register("tps")
def q_tps(spark, sf):
    t = monitoring.tps(metrics_table(spark, sf))
    return t.select("period", r6("tps").alias("tps"))


def _used(spark, sf):
    valid, _ = split(validate_events(flat_events(spark, sf)))
    return monitoring.recommendations_used(valid.select(
        "page_rid", F.unix_timestamp(F.col("timestamp").cast("timestamp")).alias("ts")))


@register("recommendations_used")
def q_recommendations_used(spark, sf):
    return _used(spark, sf)


@register("recommendation_use_rate")
def q_recommendation_use_rate(spark, sf):
    u = monitoring.recommendation_use_rate(metrics_table(spark, sf), _used(spark, sf))
    return u.select("period", "used", r6("requests").alias("requests"),
                    r6("use_rate").alias("use_rate"))


@register("reply_assembly")
def q_reply_assembly(spark, sf):
    inp, (rows, req, ranked) = _recommend(spark, sf)
    return recommend.reply_assembly(rows, req)


# -- 2.6 sort, limit, top-k ---------------------------------------------------------------

@register("sorted_interactions")
def q_sorted_interactions(spark, sf):
    return etl.sorted_interactions(interactions(spark, sf, materialized=False))


@register("topk_per_request")
def q_topk_per_request(spark, sf):
    inp, (rows, req, ranked) = _recommend(spark, sf)
    return ranked.select("request_id", "item_id", "rank", r6("score").alias("score"))


@register("fallback_filter")
def q_fallback_filter(spark, sf):
    inp, (rows, req, ranked) = _recommend(spark, sf)
    return ranked.groupBy("request_id").agg(
        F.first("filter_dated").alias("filter_dated"), F.first("backup").alias("backup"),
        F.count(F.lit(1)).alias("rows"))


# -- 2.7 dimension / item tables ---------------------------------------------------------------

@register("build_context_map")
def q_build_context_map(spark, sf):
    ctx = st.context_entries(st.build_context_map(active_settings(spark, sf),
                                                  st.filter_specs(spark)))
    return ctx.select("name", "context", "filter_name", "kind", "limit_time_range",
                      F.array_join("filter_values", "|").alias("filter_values"),
                      F.array_join("include_time_range_for_sections", "|").alias("sections"))


def _content_updates(spark, sf):
    recs = ingest.item_records(decoded_content(spark, sf), active_settings(spark, sf),
                               F.lit(INGEST_EPOCH))
    one = recs.select("record_id", "updated_ts", "itemId", "properties").distinct()
    older = one.select(F.concat("record_id", F.lit("-replay")).alias("record_id"),
                       (F.col("updated_ts") - 86400).alias("updated_ts"), "itemId",
                       F.lit("{}").alias("properties"))
    return one, older


@register("upsert_items")
def q_upsert_items(spark, sf):
    """74: an older replay of every update is merged in; the newest wins."""
    one, older = _content_updates(spark, sf)
    return ingest.upsert_items(older, one)


# -- 2.8 streaming ---------------------------------------------------------------------------------

#: Records in a landed file, at most about so many: a file is what one task writes, and two are a micro-batch.
EVENT_FILE_RECORDS = 1_000_000
CONTENT_FILE_RECORDS = 100_000


def land(records, path: str, file_records: int) -> None:
    """Records as the JSON files a stream reads: four, or as many more as their number asks for."""
    records.repartition(max(4, -(-records.count() // file_records))).write.json(path)


@register("stream_events")
def q_stream_events(spark, sf):
    """75: file stream of event records through foreachBatch; sink read back."""
    base = scratch(spark, "stream-events")
    land(fx.stream_event_json(spark, sf), f"{base}/in", EVENT_FILE_RECORDS)
    fx.settings(spark, sf).write.parquet(f"{base}/settings")
    src = stream.read_record_stream(spark, f"{base}/in", max_files_per_trigger=2)
    writer = ingest.event_batch_writer(lambda: spark.read.parquet(f"{base}/settings"),
                                       f"{base}/out", F.lit(INGEST_EPOCH))
    q = ingest.run_stream(src, writer, f"{base}/ckpt")
    q.awaitTermination()
    return spark.read.parquet(f"{base}/out/records").drop("batch_id")


REFUSE_EVERY = 3


@register("deliver_events")
def q_deliver_events(spark, sf):
    """75, 57: the event stream delivered to its trackers, the first of which refuses
    every third record; what each target took and refused over all batches."""
    base = scratch(spark, "deliver-events")
    land(fx.stream_event_json(spark, sf), f"{base}/in", EVENT_FILE_RECORDS)
    fx.settings(spark, sf).write.parquet(f"{base}/settings")
    src = stream.read_record_stream(spark, f"{base}/in", max_files_per_trigger=2)
    settings = spark.read.parquet(f"{base}/settings")
    hard = st.targets(readers.scan_active_settings(settings), "eventTrackerId")[0]
    writer = ingest.event_batch_writer(
        lambda: settings, f"{base}/out", F.lit(INGEST_EPOCH), client="recoflow.sources.delivery:RefuseEvery",
        client_options={"refuse_every": REFUSE_EVERY, "refuse_target": hard})
    ingest.run_stream(src, writer, f"{base}/ckpt").awaitTermination()
    out = ingest.delivery_path(f"{base}/out")
    took = delivery.delivered(spark, out, "trackingId string, eventId string").groupBy(
        F.col("trackingId").alias("target")).agg(F.count(F.lit(1)).alias("records"), F.countDistinct("eventId").alias("events"))
    counts = delivery.outcome(spark, out).groupBy("target").agg(
        F.sum("success").alias("success"), F.sum("fail").alias("fail"))
    return counts.join(took, "target", "left").select(
        "target", "success", "fail", F.coalesce("records", F.lit(0)).alias("records"), F.coalesce("events", F.lit(0)).alias("events"))


@register("stream_content")
def q_stream_content(spark, sf):
    """76: file stream of article records; item state (74) over the sink."""
    base = scratch(spark, "stream-content")
    land(fx.stream_content_json(spark, sf), f"{base}/in", CONTENT_FILE_RECORDS)
    fx.settings(spark, sf).write.parquet(f"{base}/settings")
    src = stream.read_record_stream(spark, f"{base}/in", max_files_per_trigger=2)
    writer = ingest.content_batch_writer(lambda: spark.read.parquet(f"{base}/settings"),
                                         f"{base}/out", F.lit(INGEST_EPOCH))
    q = ingest.run_stream(src, writer, f"{base}/ckpt")
    q.awaitTermination()
    return ingest.items_state(spark, f"{base}/out")


@register("stream_lag")
def q_stream_lag(spark, sf):
    """77: per-period consumer lag of both streams and their lag alarms
    (events: 10 consecutive periods, content: 1)."""
    ev = fx.read(spark, sf, "events")
    ev_ms = F.unix_timestamp(F.col("ts").cast("timestamp")) * 1000
    events = ev.select(F.lit("events").alias("stream"), ev_ms.alias("event_ms"),
                       (ev_ms + (F.col("event_id") % 7) * 2000).alias("arrival_ms"))
    upd_ms = fn.epoch_batch("UpdatedDate") * 1000
    content = (fx.content_flat(spark, sf)
               .select(F.lit("content").alias("stream"), upd_ms.alias("event_ms"),
                       (upd_ms + (F.col("doc_id") % 13) * 1000).alias("arrival_ms"))
               .filter(F.col("event_ms").isNotNull()))
    return (monitoring.stream_lag(events, periods=10)
            .unionByName(monitoring.stream_lag(content, periods=1)))


# -- 2.9 scoring -----------------------------------------------------------------------------------

@register("similar_items")
def q_similar_items(spark, sf):
    s = scoring.similar_items(interactions(spark, sf))
    return s.select("item_id", "similar_item_id", r6("sim").alias("sim"), "rank")


@register("similar_items_incremental")
def q_similar_items_incremental(spark, sf):
    """78 kept up: the window's older days at once, then its last days in while the first go out."""
    views = materialize(coviews.day_views(interactions(spark, sf, materialized=False)))
    last = (datetime.date.fromisoformat(AS_OF) - datetime.date(1970, 1, 1)).days
    state = coviews.CoViews(spark, scratch(spark, "coviews"))
    state.step(0, views.where(F.col("day") < last - 3), views.where("false"))
    state.step(1, views.where(F.col("day") >= last - 3), views.where(F.col("day") < last - 5))
    return state.similar_items().select("item_id", "similar_item_id", r6("sim").alias("sim"), "rank")


@register("user_personalization")
def q_user_personalization(spark, sf):
    p = scoring.user_personalization(interactions(spark, sf), items(spark, sf), AS_OF)
    return p.select("user_id", "item_id", r6("affinity").alias("affinity"), "fresh",
                    r6("score").alias("score"))


EXPLORE_SEED, EXPLORE_POOLS, EXPLORE_PLACES = "2024-01-31", 64, 25


@register("explore_items")
def q_explore_items(spark, sf):
    """79: every request's first 25 by score, with three tenths of the places for items of the last day."""
    inter, it = interactions(spark, sf), materialize(items(spark, sf))
    req = fx.requests(spark, sf).select("request_id", F.col("visitor_id").alias("user_id"), F.lit(EXPLORE_PLACES).alias("k"))
    scores = scoring.user_personalization(inter, it, AS_OF)
    w = Window.partitionBy("request_id").orderBy(F.col("score").desc(), "item_id")
    ranked = materialize(req.join(scores, "user_id").withColumn("rank", F.row_number().over(w)).where(
        F.col("rank") <= EXPLORE_PLACES).select("request_id", "item_id", "rank"))
    viewed = inter.select(F.col("USER_ID").alias("user_id"), F.col("ITEM_ID").alias("item_id")).distinct()
    return exploration.explore(req, ranked, exploration.fresh_items(it, AS_OF), viewed, EXPLORE_SEED, pools=EXPLORE_POOLS)


@register("next_items")
def q_next_items(spark, sf):
    """79: after every session's last two views, the ten likeliest next items."""
    views = flat_events(spark, sf).where("sp_event_name = 'page_view'").select(
        F.col("sp_domain_sessionid").alias("session"), fn.epoch_batch("sp_derived_tstamp").alias("ts"),
        F.col("sp_event_id").cast("long").alias("id"), F.col("content_contentid").alias("item")).dropna()
    ctx = materialize(sequences.contexts(views))
    last = ctx.groupBy("session").agg(F.max(F.struct("ts", "id", "b", "item")).alias("l")).select(
        F.col("l.b").alias("a"), F.col("l.item").alias("b"))
    return sequences.next_items(ctx, last).select("a", "b", "item_id", "order", r6("score").alias("score"), "rank")


@register("personalized_ranking")
def q_personalized_ranking(spark, sf):
    scores = scoring.user_personalization(interactions(spark, sf), items(spark, sf), AS_OF)
    c = history_candidates(spark, sf).select("request_id", "user_id", "item_id")
    r = scoring.personalized_ranking(c, scores)
    return r.select("request_id", "item_id", r6("score").alias("score"), "rank")


@register("recommend_batch")
def q_recommend_batch(spark, sf):
    inp, (rows, req, ranked) = _recommend(spark, sf)
    return rows.select("request_id", "position", "content_id", "title", "byline", "url",
                       "author_url220", "picture_url220", r6("score").alias("score"))


# -- composite ETL ---------------------------------------------------------------------------------

@register("build_interactions")
def q_build_interactions(spark, sf):
    """82: raw events -> interactions, ordered by user and time."""
    return etl.build_interactions(fx.raw_events(spark, sf), AS_OF, keys=fx.BATCH_ATTRIBUTE_KEYS)


@register("build_items")
def q_build_items(spark, sf):
    """83: content metadata -> items."""
    return etl.build_items(fx.raw_items(spark, sf), AS_OF, partitions=None)
