"""Row filters over events and items (ops 31-40, 46-48).

Every filter is a narrow transformation (no shuffle).  Negated predicates
keep NULL rows explicitly: ``NOT (x IN list)`` is NULL for a NULL ``x`` and
a plain ``filter`` would drop the row.  Predicates are stated on plain
columns so Catalyst can push them into the Parquet scan when the input is
a file source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recoflow import constants as C
from recoflow.functions.columns import midnight_epoch


def recent_interactions(df: DataFrame, as_of, ts: str = "TIMESTAMP",
                        days: int = C.INTERACTION_WINDOW_DAYS) -> DataFrame:
    """31: keep events strictly after midnight of ``as_of - days``."""
    return df.filter(F.col(ts) > midnight_epoch(as_of, days))


def recent_items(df: DataFrame, as_of, ts: str = "CREATION_TIMESTAMP",
                 days: int = C.ITEM_WINDOW_DAYS) -> DataFrame:
    """32: keep items created strictly after midnight of ``as_of - days``."""
    return df.filter(F.col(ts) > midnight_epoch(as_of, days))


def page_view_filters(df: DataFrame, app_id: str = C.APP_ID) -> DataFrame:
    """33: the web property's article page views."""
    return df.filter((F.col("sp_app_id") == app_id)
                     & (F.col("sp_event_name") == C.PAGE_VIEW)
                     & (F.col("page_type") == C.ARTICLE))


def content_id_filters(df: DataFrame, c: str = "content_contentid") -> DataFrame:
    """34: an item id is present and is not a URL."""
    return df.filter(F.col(c).isNotNull() & ~F.col(c).contains("http"))


def bot_filter(df: DataFrame, c: str = "device_detector_visitorplatform") -> DataFrame:
    """35: drop crawler platforms; unknown platform is kept."""
    return df.filter(F.col(c).isNull() | (F.col(c) != C.BOT_PLATFORM))


def premium_filter(df: DataFrame, c: str = "visitor_servicecode") -> DataFrame:
    """36: drop premium-bundle service codes; NULL is kept."""
    return df.filter(F.col(c).isNull() | ~F.col(c).contains(C.PREMIUM_SERVICE_CODE))


def isp_denylist(df: DataFrame, c: str = "sp_ip_isp", denylist=C.ISP_DENYLIST) -> DataFrame:
    """37: drop denied ISPs; NULL is kept."""
    return df.filter(F.col(c).isNull() | ~F.col(c).isin(list(denylist)))


def host_denylist(df: DataFrame, c: str = "sp_page_urlhost", denylist=C.HOST_DENYLIST) -> DataFrame:
    """38: drop denied page hosts; NULL is kept.

    The list is a handful of literals, so ``isin`` compiles to an in-set
    check inside codegen; a deny *table* should instead be a broadcast
    ``left_anti`` join (see ``host_denylist_table``).
    """
    return df.filter(F.col(c).isNull() | ~F.col(c).isin(list(denylist)))


def host_denylist_table(df: DataFrame, hosts: DataFrame, c: str = "sp_page_urlhost",
                        host_col: str = "host") -> DataFrame:
    """38 (table form): anti join against a deny table of hosts.

    NULL hosts never match an equi-join key, so they are kept, as in the
    literal form.  Adaptive execution picks the
    join from the measured size of the deny table.
    """
    deny = hosts.select(F.col(host_col).alias("__deny_host")).distinct()
    return df.join(deny, F.col(c) == F.col("__deny_host"), "left_anti")


INTERACTION_REQUIRED = ("USER_ID", "ITEM_ID", "TIMESTAMP", "EVENT_TYPE")
ITEM_REQUIRED = ("ITEM_ID", "CREATION_TIMESTAMP", "ContentText")


def drop_incomplete_interactions(df: DataFrame) -> DataFrame:
    """39: drop rows with a NULL in any required interaction column."""
    return df.na.drop(subset=list(INTERACTION_REQUIRED))


def drop_incomplete_items(df: DataFrame) -> DataFrame:
    """40: drop rows with a NULL in any required item column."""
    return df.na.drop(subset=list(ITEM_REQUIRED))


def passes_age(as_of, days: int = C.ITEM_AGE_FILTER_DAYS, created: str = "CREATION_TIMESTAMP") -> Column:
    """46 as a flag: not (created < midnight(as_of - days)); a NULL time is not below it."""
    return ~F.coalesce(F.col(created) < midnight_epoch(as_of, days), F.lit(False))


def item_filter_age(df: DataFrame, as_of, ts: str = "CREATION_TIMESTAMP",
                    days: int = C.ITEM_AGE_FILTER_DAYS) -> DataFrame:
    """46: the dated filters' extra clause, EXCLUDE creation < midnight(as_of - 3d)."""
    return df.filter(passes_age(as_of, days, ts))


def drop_last_content(df: DataFrame, item: str = "content_id",
                      last: str = "last_content_ids") -> DataFrame:
    """48: remove the article the visitor is reading (only when one is given)."""
    cond = F.col(last).isNotNull() & (F.length(F.col(last)) > 0) & (F.col(item) == F.col(last))
    return df.filter(~F.coalesce(cond, F.lit(False)))
