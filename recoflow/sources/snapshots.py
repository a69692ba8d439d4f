"""Published snapshots of several datasets (op 5).

A publish claims the next version number (a file that only one caller can
create), writes every dataset to a folder of its own, reads it back for its row count
and an order-free checksum, and writes one manifest of all datasets last.
Readers resolve a manifest, so all datasets come from one version; with
``verify`` a dataset whose rows or checksum differ is refused. A failed publish
leaves a number without a manifest. ``retain`` removes old versions except those that a
reader holds.

Layout under ``dest``::

    _claims/<version>               numbers given out
    _manifests/v=<version>/         dataset, path, fields, rows, checksum
    _held/<version>/<reader>        versions in use
    <dataset>/v=<label>/            data (CSV); the label is the version unless given
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recoflow.sources import files
from recoflow.sources.csvio import read_csv, write_csv

MANIFEST = "version long, label string, dataset string, path string, fields string, rows long, checksum string"


def checksum(columns: list[str]) -> Column:
    """Sum of the rows' hashes: the same in any order, different for repeated or lost rows."""
    return F.coalesce(F.sum(F.xxhash64(*[F.col(c) for c in columns]).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).cast("string")


def _as_text(spark: SparkSession, path: str, fields: list[str]) -> DataFrame:
    return read_csv(spark, path, T.StructType([T.StructField(f, T.StringType()) for f in fields]))


def _number(version: int) -> str:
    return f"{version:012d}"


def claim_version(spark: SparkSession, dest: str) -> int:
    """The next version: greater than all given out before, also by publishers at the same time."""
    version = max((int(n) for n in files.names(spark, f"{dest}/_claims") if n.isdigit()), default=0) + 1
    while not files.create_once(spark, f"{dest}/_claims/{_number(version)}"):
        version += 1
    return version


def publish(spark: SparkSession, sources: dict[str, DataFrame], dest: str, label: str | None = None, version: int | None = None) -> int:
    """Publish datasets as one version; returns its number."""
    version = version if version is not None else claim_version(spark, dest)
    label = label or _number(version)
    rows = []
    for name, df in sources.items():
        path = f"{dest}/{name}/v={label}"
        write_csv(df, path)
        seen = _as_text(spark, path, df.columns).agg(F.count(F.lit(1)), checksum(df.columns)).first()
        rows.append((version, label, name, path, "\n".join(df.columns), seen[0], seen[1]))
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("overwrite").json(f"{dest}/_manifests/v={_number(version)}")
    return version


def versions(spark: SparkSession, dest: str) -> list[int]:
    """Complete versions, oldest first."""
    found = [n[2:] for n in files.names(spark, f"{dest}/_manifests") if n.startswith("v=")]
    return [int(n) for n in sorted(found) if files.exists(spark, f"{dest}/_manifests/v={n}/_SUCCESS")]


def manifest(spark: SparkSession, dest: str, version: int | None = None) -> dict[str, T.Row]:
    """dataset -> manifest row of a version (default: the newest)."""
    if version is None:
        done = versions(spark, dest)
        if not done:
            raise FileNotFoundError(f"nothing published under {dest}")
        version = done[-1]
    rows = spark.read.schema(MANIFEST).json(f"{dest}/_manifests/v={_number(version)}").collect()
    return {r.dataset: r for r in rows}


def verify(spark: SparkSession, row: T.Row) -> None:
    """Refuse a dataset that is not what was published."""
    fields = row.fields.split("\n")
    seen = _as_text(spark, row.path, fields).agg(F.count(F.lit(1)), checksum(fields)).first()
    if (seen[0], seen[1]) != (row.rows, row.checksum):
        raise ValueError(f"{row.dataset} of version {row.version} is damaged: {seen[0]} rows, {row.rows} published")


def read(spark: SparkSession, dest: str, schemas: dict[str, T.StructType], version: int | None = None,
         check: bool = True) -> dict[str, DataFrame]:
    """Datasets of one version. A version that lacks one of them is an error, as is a damaged one (where checked)."""
    rows = manifest(spark, dest, version)
    lacking = sorted(set(schemas) - set(rows))
    if lacking:
        raise KeyError(f"not in the version: {', '.join(lacking)}")
    for name in schemas if check else ():
        verify(spark, rows[name])
    return {name: read_csv(spark, rows[name].path, schema) for name, schema in schemas.items()}


def hold(spark: SparkSession, dest: str, version: int) -> str:
    """Mark a version as in use; the returned path is given to ``release``."""
    path = f"{dest}/_held/{_number(version)}/{uuid.uuid4().hex}"
    files.create_once(spark, path)
    if version not in versions(spark, dest):  # removed in between
        release(spark, path)
        raise FileNotFoundError(f"version {version} is gone")
    return path


def release(spark: SparkSession, held: str) -> None:
    files.remove(spark, held)


def retain(spark: SparkSession, dest: str, keep: int) -> list[int]:
    """Remove all but the newest ``keep`` versions and those held; returns the removed ones. The manifest goes first, so
    nothing resolves to a version whose data is going."""
    done = versions(spark, dest)
    gone = [v for v in done[:-keep or None] if not files.names(spark, f"{dest}/_held/{_number(v)}")]
    paths = {v: [r.path for r in manifest(spark, dest, v).values()] for v in done}
    for v in gone:
        files.remove(spark, f"{dest}/_manifests/v={_number(v)}")
        used = {p for w in done if w not in gone for p in paths[w]}
        for path in set(paths[v]) - used:
            files.remove(spark, path)
    return gone
