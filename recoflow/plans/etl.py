"""The two batch ETL jobs (ops 82 and 83) as ``DataFrame.transform`` chains.

Both are a single lazy plan: scan -> narrow projections and filters ->
(optional) global sort.  Filters run before the final projection so the
scan can prune columns and push predicates; the only shuffle is the sort
of ``sorted_interactions``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recoflow.functions import columns as fn
from recoflow.operators import filters as flt
from recoflow.operators.projections import apply_mapping, pivot_attributes
from recoflow.sources.readers import scan_rolling_month

INTERACTION_COLUMNS = (
    "USER_ID", "ITEM_ID", "TIMESTAMP", "EVENT_TYPE", "visitor_type", "visitor_countrycode",
    "device_detector_visitorplatform", "device_detector_brandname",
    "device_detector_browserfamily",
)
ITEM_COLUMNS = ("ITEM_ID", "CREATION_TIMESTAMP", "ContentText", "Category", "WordCount", "Exclude")


def interaction_rules(events: DataFrame) -> DataFrame:
    """33-38: the batch event rules, applied to pivoted events."""
    return (events
            .transform(flt.page_view_filters)
            .transform(flt.content_id_filters)
            .transform(flt.bot_filter)
            .transform(flt.premium_filter)
            .transform(flt.isp_denylist)
            .transform(flt.host_denylist))


def to_interactions(events: DataFrame) -> DataFrame:
    """13 + 15 + final projection: pivoted events -> the 9 interaction columns."""
    return events.select(
        fn.resolve_user_batch().alias("USER_ID"),
        F.col("content_contentid").alias("ITEM_ID"),
        fn.epoch_batch("sp_derived_tstamp").alias("TIMESTAMP"),
        F.col("sp_event_name").alias("EVENT_TYPE"),
        "visitor_type", "visitor_countrycode", "device_detector_visitorplatform",
        "device_detector_brandname", "device_detector_browserfamily",
    )


MAP_COLUMN = "eventAttributes"


def promote_attributes(raw_events: DataFrame, path: str, keys: Sequence[str] | None = None,
                       partition_by: Sequence[str] = ("year", "month", "day")) -> str:
    """Compaction: rewrite raw events with the attributes as top-level columns.

    Predicates on map values cannot be pushed into Parquet and every query
    reads the whole map.  Written once per day partition, the flat store
    lets later jobs read only the columns they use and skip row groups by
    statistics (``PushedFilters``).  Partitioned by date like the source,
    so the rolling-month scan still prunes folders.
    """
    pivot_attributes(raw_events, keys).write.mode("overwrite").partitionBy(
        *partition_by).parquet(path)
    return path


def sorted_interactions(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """66: order by (USER_ID, TIMESTAMP).

    A global ``orderBy`` is a range-partitioned shuffle + per-partition sort:
    every task sorts its own range and output files are ordered end to end.
    ``partitions`` fixes the number of output ranges (e.g. 1 for a single
    file on small data); by default AQE sizes them.
    """
    if partitions is None:
        return df.orderBy("USER_ID", "TIMESTAMP")
    return df.repartitionByRange(partitions, "USER_ID", "TIMESTAMP").sortWithinPartitions(
        "USER_ID", "TIMESTAMP")


def build_interactions(raw_events: DataFrame, as_of, keys: Sequence[str] | None = None,
                       sort: bool = True, partitions: int | None = None) -> DataFrame:
    """82: raw partitioned events -> clean, ordered interactions.

    1 (rolling-month partitions) -> 11 (pivot) -> 33-38 (rules) -> 13/15
    (user, epoch) -> 31 (7-day window) -> 39 (required columns) -> 66 (sort).
    A store already flattened by ``promote_attributes`` skips the pivot, and
    the rule predicates then reach the Parquet reader as pushed filters.
    """
    events = scan_rolling_month(raw_events, as_of)
    if MAP_COLUMN in events.columns:
        events = pivot_attributes(events, keys)
    out = (interaction_rules(events)
           .transform(to_interactions)
           .transform(lambda d: flt.recent_interactions(d, as_of))
           .transform(flt.drop_incomplete_interactions))
    return sorted_interactions(out, partitions) if sort else out


def to_items(mapped: DataFrame) -> DataFrame:
    """15 + 17 + final projection on mapped content rows."""
    return mapped.select(
        "ITEM_ID",
        fn.epoch_batch("CREATION_TIMESTAMP").alias("CREATION_TIMESTAMP"),
        "ContentText", "Category", "WordCount",
        fn.exclude_flag_batch().alias("Exclude"),
    )


def single_partition_items(df: DataFrame, partitions: int | None = 1) -> DataFrame:
    """67: reduce output partitions without a full shuffle (``coalesce``).

    ``None`` leaves partitioning alone (the right choice at scale).
    """
    return df if partitions is None else df.coalesce(partitions)


def build_items(raw_items: DataFrame, as_of, partitions: int | None = None) -> DataFrame:
    """83: content metadata -> items dataset.

    2 -> 12 (mapping) -> 15/17 (epoch, exclude flag) -> 32 (14-day window)
    -> 40 (required columns) -> 67 (optional coalesce).
    """
    out = (apply_mapping(raw_items)
           .transform(to_items)
           .transform(lambda d: flt.recent_items(d, as_of))
           .transform(flt.drop_incomplete_items))
    return single_partition_items(out, partitions)
