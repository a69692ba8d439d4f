"""Datasets as CSV, the import format of the downstream service."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from recoflow.sources import files

CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"'}


def write_csv(df: DataFrame, path: str, partitions: int | None = None) -> str:
    """Replace ``path`` by ``df`` as CSV.  ``partitions`` optionally
    coalesces the output (1 = one file, only sensible for small outputs)."""
    out = df if partitions is None else df.coalesce(partitions)
    staged = f"{path.rstrip('/')}.new-{uuid.uuid4().hex}"
    out.write.options(**CSV_OPTIONS).csv(staged)
    files.replace(df.sparkSession, staged, path)
    return path


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read a dataset written by ``write_csv``.

    The writer emits NULL as an empty field and '' as a quoted empty
    string.  With the reader's default ``nullValue`` ('') both would come
    back NULL, so the reader's null marker is set to a character that
    never occurs in the data: unquoted empty fields still read as NULL and
    quoted empty strings stay ''.
    """
    return (spark.read.options(**CSV_OPTIONS).option("multiLine", "true")
            .option("nullValue", "\u0000").schema(schema).csv(path))
