"""Shared helpers: intermediate tables, keys for documents, Arrow batches."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Stands for a null id wherever ids are ordered or joined; it sorts first.
NULL_ID = -(1 << 63)
#: Text is worked on in slices of about so many bytes, so that the arrays
#: made from a slice stay small whatever the batch size (under 2**21, the
#: length of the hashes' tables of powers).
SLICE_BYTES = 2_000_000


def ship(spark: SparkSession) -> SparkSession:
    """Make this package importable in the Python workers (once a session)."""
    sc = spark.sparkContext
    if not any("recoflow" in name for name in sc._python_includes):
        root = Path(__file__).resolve().parents[1]
        target = Path(tempfile.mkdtemp(prefix="recoflow-ship-")) / "recoflow.zip"
        with zipfile.ZipFile(target, "w") as out:
            for file in sorted(root.rglob("*.py")):
                out.write(file, Path("recoflow") / file.relative_to(root))
        sc.addPyFile(str(target))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder shared by driver and executors (``spark.checkpoint.dir``).

    Where it is unset, a local master gets a scratch folder of its own;
    on a cluster the missing setting is an error, since executors cannot
    see one another's local files.
    """
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if found:
        return found.rstrip("/")
    if not sc.master.startswith("local[") and sc.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    made = tempfile.mkdtemp(prefix="recoflow-llm-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def materialize(df: DataFrame, name: str, batch_rows: int | None = None, sort_groups: bool = False, bucket_by: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet to the shared folder and read it back.

    Cuts the lineage: a lost executor re-reads files, nothing upstream is
    run twice, and later readers prune columns. ``batch_rows``: rows that
    Python is sent at once, for tables whose rows are large. ``sort_groups``:
    lists are collected from sorted rows, for more groups than a hash map holds.
    ``bucket_by``: written in as many buckets by this column as a shuffle has
    partitions, so that what needs its rows together does not shuffle them; the
    table that Spark wants for that is dropped at once, the files stay.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/recoflow-llm/{name}-{uuid.uuid4().hex}"
    # once written, the shuffle files are of no more use
    wanted = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
    if batch_rows:
        wanted["spark.sql.execution.arrow.maxRecordsPerBatch"] = str(batch_rows)
    if sort_groups:
        wanted["spark.sql.execution.useObjectHashAggregateExec"] = "false"
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        writer = df.write.option("compression", "zstd")
        if bucket_by:
            table = f"recoflow_{uuid.uuid4().hex}"
            parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
            writer.format("parquet").option("path", path).bucketBy(parts, bucket_by).saveAsTable(table)
        else:
            writer.parquet(path)
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
    if bucket_by:
        out = spark.table(table)
        spark.sql(f"DROP TABLE {table}")
    else:
        out = spark.read.schema(df.schema).parquet(path)
    out._recoflow_path = path
    return out


def discard(df: DataFrame) -> None:
    """Delete a table made by ``materialize`` that nothing reads any more."""
    path = df._recoflow_path
    jvm = df.sparkSession.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(target, True)


def doc_key(id_col: str = "doc_id", text_col: str = "text") -> list[Column]:
    """(_id, _th): null-free id and text hash, which together name a document.

    Rows with the same id and the same text are one document and get the
    same result; rows with the same id and other text are other documents.
    """
    return [F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("_id"),
            F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("_th")]


def text_slices(texts: pa.Array, max_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """(first row, rows) in order; each slice has about ``max_bytes``, or one longer text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    sizes = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))])
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(sizes, sizes[at] + max_bytes, side="right")) - 1)
        yield at, texts.slice(at, end - at)
        at = end

