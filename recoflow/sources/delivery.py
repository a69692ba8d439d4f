"""Delivery sink with an outcome per record and target (ops 52, 53, 57, 75).

A Python data source (``recoflow_delivery``): each task hands its records to a
client, one by one and per target. A refused record is counted and kept with
its reason; it ends neither the task nor the batch. Tasks stage what
they delivered; the commit messages name it, and only the commit publishes, so
failed and speculative attempts deliver nothing. Publishing replaces the
batch's folder and the outcome is written last: a retried batch delivers
nothing twice, whether it stopped before, within or after its commit.

Layout under ``sink``, a folder of its own::

    <target>/batch_id=<b>/<task>.jsonl   delivered records
    _refused/batch_id=<b>/<task>.jsonl   refused ones: target, reason, record
    _outcome/batch_id=<b>/part.json      {"batch_id", "target", "success", "fail"} a line

A client is made in each task by ``client`` (``module:factory``; called with the
options). It has ``put(target, record, key)``, which raises to refuse, and whose
``key`` (batch, target, record id) is the same on every attempt, for services that
drop repeats by key. The default accepts everything. Whatever a client does,
accepted records are also in the target's folder.
"""

from __future__ import annotations

import importlib
import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from recoflow.session import ship
from recoflow.sources import files

FORMAT = "recoflow_delivery"
OUTCOME_SCHEMA = "batch_id long, target string, success long, fail long"


class Refused(Exception):
    """A target did not take a record."""


class AcceptAll:
    def __init__(self, options: dict):
        pass

    def put(self, target: str, record: dict, key: str) -> None:
        pass


class RefuseEvery:
    """A client for drills: refuses records whose id's digits are divisible by ``refuse_every``
    (of ``refuse_target`` only, where given)."""

    def __init__(self, options: dict):
        self.every, self.only = int(options["refuse_every"]), options.get("refuse_target")

    def put(self, target: str, record: dict, key: str) -> None:
        digits = re.sub(r"\D", "", key.rsplit(":", 1)[1])
        if self.only in (None, target) and int(digits or 1) % self.every == 0:
            raise Refused(f"{target} takes no {digits}")


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder given by URI or local path."""
    local = re.sub(r"^file:/+", "/", uri)
    if "://" not in local:
        return pafs.LocalFileSystem(), local.rstrip("/")
    found, path = pafs.FileSystem.from_uri(local)
    return found, path.rstrip("/")


def _load(name: str | None):
    if not name:
        return AcceptAll
    module, _, attribute = name.partition(":")
    return getattr(importlib.import_module(module), attribute)


@dataclass
class Staged(WriterCommitMessage):
    """What one task left in staging, and its counts per target."""

    folder: str
    files: list[str] = field(default_factory=list)  # "<target>" or "_refused", quoted
    counts: dict[str, list[int]] = field(default_factory=dict)


class DeliveryWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.options = {k.lower(): v for k, v in options.items()}
        self.sink = self.options["sink"]
        self.batch = int(self.options["batch_id"])
        self.target = self.options["target"]
        self.key = self.options["key"]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        store, root = open_fs(self.sink)
        name = uuid.uuid4().hex
        staged = Staged(f"{root}/_staging/batch_id={self.batch}/{name}")
        client = _load(self.options.get("client"))(self.options)
        outputs: dict[str, pa.NativeFile] = {}

        def put(folder: str, row: dict) -> None:
            if folder not in outputs:
                store.create_dir(f"{staged.folder}", recursive=True)
                outputs[folder] = store.open_output_stream(f"{staged.folder}/{folder}.jsonl")
                staged.files.append(folder)
            outputs[folder].write((json.dumps(row, ensure_ascii=False, default=str) + "\n").encode())

        try:
            for batch in iterator:
                for row in batch.to_pylist():
                    target = row[self.target]
                    counts = staged.counts.setdefault(target, [0, 0])
                    try:
                        client.put(target, row, f"{self.batch}:{target}:{row.get(self.key)}")
                    except Exception as why:  # noqa: BLE001 - a failing target must not end the batch
                        counts[1] += 1
                        put("_refused", {"target": target, "reason": str(why) or type(why).__name__, "record": json.dumps(row, default=str)})
                    else:
                        counts[0] += 1
                        put(quote(target, safe=""), row)
        finally:
            for out in outputs.values():
                out.close()
        return staged

    def commit(self, messages: list[Staged | None]) -> None:
        store, root = open_fs(self.sink)
        done = [m for m in messages if m is not None]
        self._remove(store, f"{root}/_outcome/batch_id={self.batch}")
        for folder in sorted({f for m in done for f in m.files} | set(self._published(store, root))):
            self._remove(store, f"{root}/{folder}/batch_id={self.batch}")
        counts: dict[str, list[int]] = {}
        for m in done:
            for folder in m.files:
                final = f"{root}/{folder}/batch_id={self.batch}"
                store.create_dir(final, recursive=True)
                store.move(f"{m.folder}/{folder}.jsonl", f"{final}/{m.folder.rsplit('/', 1)[1]}.jsonl")
            for target, (ok, bad) in m.counts.items():
                total = counts.setdefault(target, [0, 0])
                total[0] += ok
                total[1] += bad
        self._remove(store, f"{root}/_staging/batch_id={self.batch}")
        lines = [json.dumps({"batch_id": self.batch, "target": t, "success": ok, "fail": bad}) for t, (ok, bad) in sorted(counts.items())]
        store.create_dir(f"{root}/_outcome/batch_id={self.batch}", recursive=True)
        made = f"{root}/_outcome/batch_id={self.batch}/_part.tmp"
        with store.open_output_stream(made) as out:
            out.write("".join(line + "\n" for line in lines).encode())
        store.move(made, f"{root}/_outcome/batch_id={self.batch}/part.json")

    def abort(self, messages: list[Staged | None]) -> None:
        store, root = open_fs(self.sink)
        self._remove(store, f"{root}/_staging/batch_id={self.batch}")

    def _published(self, store: pafs.FileSystem, root: str) -> list[str]:
        """Folders in which a broken commit of this batch may have left files."""
        if store.get_file_info(root).type != pafs.FileType.Directory:
            return []
        return [i.base_name for i in store.get_file_info(pafs.FileSelector(root))
                if i.type == pafs.FileType.Directory and i.base_name not in ("_staging", "_outcome")]

    @staticmethod
    def _remove(store: pafs.FileSystem, path: str) -> None:
        if store.get_file_info(path).type == pafs.FileType.Directory:
            store.delete_dir(path)


class DeliverySource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite: bool) -> DeliveryWriter:
        return DeliveryWriter(dict(self.options))


def is_delivered(spark: SparkSession, sink: str, batch_id: int) -> bool:
    return files.exists(spark, f"{sink}/_outcome/batch_id={batch_id}/part.json")


def deliver(records: DataFrame, sink: str, batch_id: int, target: str, key: str, client: str | None = None,
            options: dict | None = None) -> DataFrame:
    """Deliver a batch unless it is delivered already; returns its outcome (batch_id, target, success, fail)."""
    spark = records.sparkSession
    if not is_delivered(spark, sink, batch_id):
        ship(spark, __name__)
        spark.dataSource.register(DeliverySource)
        writer = records.write.format(FORMAT).mode("append").option("sink", sink).option("batch_id", batch_id)
        writer = writer.option("target", target).option("key", key)
        writer = writer.options(**(options or {}))
        (writer.option("client", client) if client else writer).save()
    return outcome(spark, sink, batch_id)


def outcome(spark: SparkSession, sink: str, batch_id: int | None = None) -> DataFrame:
    """Counts per target: of one batch, or of all."""
    folder = f"{sink}/_outcome" if batch_id is None else f"{sink}/_outcome/batch_id={batch_id}/part.json"
    read = spark.read.schema(OUTCOME_SCHEMA).option("recursiveFileLookup", "true")
    return read.json(folder)


def delivered(spark: SparkSession, sink: str, schema: str) -> DataFrame:
    """All delivered records (``schema`` has the target's column, too) of complete batches."""
    done = outcome(spark, sink).select("batch_id").distinct()
    names = [f for f in files.subfolders(spark, sink) if not f.startswith("_")]
    if not names:
        return spark.createDataFrame([], f"{schema}, batch_id long")
    rows = spark.read.schema(schema).option("recursiveFileLookup", "true").json([f"{sink}/{n}" for n in names])
    batch = F.regexp_extract(F.col("_metadata.file_path"), r"/batch_id=(\d+)/", 1).cast("long")
    return rows.select("*", batch.alias("batch_id")).join(done, "batch_id", "left_semi")
