"""Record validation (ops 10, 41, 42).

Validation never filters silently: it adds a ``skip_reason`` column
(NULL = valid) computed by one ``CASE`` chain in which the first failing
check decides the reason, then ``split`` routes rows.  Everything is a
narrow projection.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recoflow import constants as C
from recoflow.functions.columns import is_blank


def first_failure(checks: Sequence[tuple[Column, str]]) -> Column:
    """``checks`` are (failure condition, reason); NULL conditions count as passing."""
    out = None
    for cond, reason in checks:
        cond = F.coalesce(cond, F.lit(False))
        out = F.when(cond, F.lit(reason)) if out is None else out.when(cond, F.lit(reason))
    return out


def event_checks(app_id: str = C.APP_ID, host_denylist=C.HOST_DENYLIST):
    """The ten ordered stream checks of a click event."""
    c = F.col
    return [
        (c("sp_event_id").isNull(), "NO_EVENT_ID"),
        (is_blank("sp_derived_tstamp"), "NO_TIME"),
        (c("sp_app_id").isNull() | (c("sp_app_id") != app_id), "OTHER_APP"),
        (is_blank("content_contentId"), "NO_ITEM"),
        (c("page_type").isNull() | (c("page_type") != C.ARTICLE), "NOT_AN_ARTICLE"),
        (c("device_detector_visitorPlatform") == C.BOT_PLATFORM,
         "BOT"),
        (c("sp_page_urlhost").isin(list(host_denylist)), "DENIED_HOST"),
        (c("sp_event_name").isNull() | (c("sp_event_name") != C.PAGE_VIEW), "NOT_A_PAGE_VIEW"),
        (c("sp_domain_sessionid").isNull(), "NO_SESSION"),
        (is_blank("sp_user_id") & is_blank("sp_domain_userid"), "NO_USER"),
    ]


def validate_events(events: DataFrame, app_id: str = C.APP_ID) -> DataFrame:
    """41: add ``skip_reason`` to decoded stream events."""
    return events.withColumn("skip_reason", first_failure(event_checks(app_id)))


def content_checks():
    c = F.col
    return [
        (c("ContentId").isNull() | c("Category").isNull(), "NO_ID_OR_CATEGORY"),
        (~F.coalesce(c("Published") == F.lit(True), F.lit(False)), "NOT_PUBLISHED"),
        (c("ContentText").isNull(), "NO_TEXT"),
    ]


def validate_content(content: DataFrame) -> DataFrame:
    """42: add ``skip_reason`` to decoded article updates."""
    return content.withColumn("skip_reason", first_failure(content_checks()))


def split(df: DataFrame, reason: str = "skip_reason") -> tuple[DataFrame, DataFrame]:
    """(valid rows without the reason column, skipped rows)."""
    return df.filter(F.col(reason).isNull()).drop(reason), df.filter(F.col(reason).isNotNull())


def validate_dataset(df: DataFrame, fields) -> DataFrame:
    """10: conform rows to a dataset schema at import.

    Each declared field is cast with ``try_cast`` (a value that does not
    fit becomes NULL instead of failing the job); a required field that is
    missing or does not cast gives ``skip_reason``.  Extra columns are
    dropped; ``fields``: a schema, whose fields' flags (metadata) the
    result keeps, or (name, spark type, nullable) triples.
    """
    if isinstance(fields, T.StructType):
        declared = [(f.name, f.dataType.simpleString(), f.nullable, f.metadata) for f in fields]
    else:
        declared = [(*f, None) for f in fields]
    cols, checks = [], []
    for name, typ, nullable, metadata in declared:
        if name in df.columns:
            v = F.col(name).try_cast(typ)
            bad_cast = F.col(name).isNotNull() & v.isNull()
        else:
            v = F.lit(None).cast(typ)
            bad_cast = F.lit(False)
        cols.append(v.alias(name, metadata=metadata) if metadata else v.alias(name))
        checks.append((bad_cast, f"bad {name}"))
        if not nullable:
            checks.append((v.isNull(), f"missing {name}"))
    ordered = [ch for ch in checks if ch[1].startswith("missing")] + \
              [ch for ch in checks if ch[1].startswith("bad")]
    return df.select(*cols, first_failure(ordered).alias("skip_reason"))
