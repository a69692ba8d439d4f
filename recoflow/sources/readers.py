"""Batch sources (ops 1, 2, 9)."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def rolling_month_predicate(as_of, year: str = "year", month: str = "month",
                            day: str = "day") -> Column:
    """Dates in (as_of - 1 month, as_of], stated on the partition columns.

    ``as_of`` is a date (text or ``datetime.date``), so the range is known when the
    plan is made and becomes plain comparisons of year, month and day with
    literals, which a metastore evaluates on its partition list and Spark on folder names
    (``PartitionFilters``); other partitions are not even listed. A real date range
    also covers January (previous December) and months of different length.
    """
    end = as_of if isinstance(as_of, datetime.date) else datetime.date.fromisoformat(str(as_of))
    last_month = end.replace(day=1) - datetime.timedelta(days=1)
    start = last_month.replace(day=min(end.day, last_month.day))  # excluded, as add_months has it
    y, m, d = F.col(year), F.col(month), F.col(day)
    old = (y == start.year) & (m == start.month) & (d > start.day)
    new = (y == end.year) & (m == end.month) & (d <= end.day)
    return old | new


def scan_rolling_month(df: DataFrame, as_of) -> DataFrame:
    """1: the event partitions of the rolling month ending at ``as_of``."""
    return df.filter(rolling_month_predicate(as_of))


def read_raw_events(spark: SparkSession, path: str, as_of) -> DataFrame:
    """1 on storage: partitioned raw events with the pruned date range."""
    return scan_rolling_month(spark.read.parquet(path), as_of)


def scan_content(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """2: content metadata as stored: a catalog table name or a path."""
    if "/" not in path and spark.catalog.tableExists(path):
        return spark.table(path)
    return spark.read.format(fmt).load(path)


def scan_active_settings(settings: DataFrame) -> DataFrame:
    """9: settings rows whose status is ``active``."""
    return settings.filter(F.col("status") == "active")
