"""Outgoing records of the stream jobs (ops 20, 21, 22), as columns.

A record is a ``struct``; ``to_json`` renders it.  Optional fields are
left NULL and dropped by ``to_json`` (its default ``ignoreNullFields``),
while property bags keep explicit nulls like the source system does.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from recoflow.functions import columns as fn

KEEP_NULLS = {"ignoreNullFields": "false"}

EVENT_PROPERTY_FIELDS = (
    "visitor_type", "visitor_countryCode", "device_detector_visitorPlatform",
    "device_detector_brandName", "device_detector_browserFamily",
)


def event_properties_json() -> Column:
    """21: the five categorical event properties as JSON text (nulls kept)."""
    return F.to_json(F.struct(*[F.col(c) for c in EVENT_PROPERTY_FIELDS]), KEEP_NULLS)


def event_record(ingest_time) -> Column:
    """20: the put-event record of one validated stream event.

    ``recommendationId`` is present only when the event carries ``page_rid``.
    """
    event = F.struct(
        F.col("sp_event_id").alias("eventId"),
        F.col("sp_event_name").alias("eventType"),
        F.col("content_contentId").alias("itemId"),
        fn.epoch_stream("sp_derived_tstamp", ingest_time).alias("sentAt"),
        event_properties_json().alias("properties"),
        F.col("page_rid").alias("recommendationId"),
    )
    return F.struct(
        F.col("sp_domain_sessionid").alias("sessionId"),
        fn.resolve_user_stream().alias("userId"),
        F.array(event).alias("eventList"),
    )


def item_properties(ingest_time) -> Column:
    """The seven item properties (text cut to the service limit)."""
    return F.struct(
        fn.truncate_text("ContentText").alias("ContentText"),
        F.col("Category"),
        F.col("WordCount"),
        F.col("Published"),
        F.col("ContentType"),
        fn.exclude_flag_stream().alias("Exclude"),
        fn.epoch_stream("UpdatedDate", ingest_time).alias("CREATION_TIMESTAMP"),
    )


def item_record(ingest_time) -> Column:
    """22: the put-item record: item id and its properties as JSON text."""
    return F.struct(
        F.col("ContentId").alias("itemId"),
        F.to_json(item_properties(ingest_time), KEEP_NULLS).alias("properties"),
    )
