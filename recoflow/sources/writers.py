"""Sinks (ops 3, 4, 5).

Datasets are written as CSV with a header (the import format of the
downstream service).  Article text holds newlines and quotes, so quotes
are escaped by doubling and readers must use ``multiLine``.  A dataset is
written beside its folder and put in its place when it is complete, so a
failed job leaves the old one; snapshots are in ``snapshots``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from recoflow.sources import snapshots
from recoflow.sources.csvio import CSV_OPTIONS, read_csv, write_csv

__all__ = ["CSV_OPTIONS", "read_csv", "write_csv"]


def write_interactions(df: DataFrame, path: str, partitions: int | None = None,
                       table: str | None = None) -> str:
    """3: interactions dataset as CSV (optionally registered as an external table; a
    managed table of that name is refused, its data would be lost)."""
    spark = df.sparkSession
    known = bool(table) and spark.catalog.tableExists(table)
    if known and spark.catalog.getTable(table).tableType != "EXTERNAL":
        raise ValueError(f"{table} is not an external table")
    write_csv(df, path, partitions)
    if known:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
        spark.catalog.refreshTable(table)
    elif table:
        spark.catalog.createTable(table, path=path, source="csv", schema=df.schema,
                                  **CSV_OPTIONS, multiLine="true")
    return path


def write_items(df: DataFrame, path: str, partitions: int | None = None) -> str:
    """4: items dataset as CSV."""
    return write_csv(df, path, partitions)


def refresh_snapshot(spark: SparkSession, sources: dict[str, DataFrame], dest: str,
                     version: str | None = None) -> int:
    """5: publish several datasets as one version under ``dest`` (``version``: a name for its folders)."""
    return snapshots.publish(spark, sources, dest, label=version)


def current_snapshot(spark: SparkSession, dest: str, name: str, schema: T.StructType) -> DataFrame:
    """One dataset of the newest published version; several at once: ``snapshots.read``."""
    return snapshots.read(spark, dest, {name: schema})[name]
