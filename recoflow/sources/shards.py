"""Sharded record log as a stream source (ops 6, 7).

A Python data source (``recoflow_shards``). A log is a folder per shard; records
have a sequence number within their shard and are appended as immutable
segments ``shard=<name>/<first sequence>-<records>.jsonl``, so a listing alone
tells where every shard ends. A micro-batch takes from each shard at most
``batches_per_shard`` batches of ``records_per_batch`` consecutive records; a batch is
read in order, by one input partition of its own or with others (``batches_per_task``,
for logs of many shards: a task costs more than a hundred records). The start is LATEST (records appended after the
query's first start) or EARLIEST.

Offsets are the next sequence per shard. Spark asks a Python source for its
latest offset without telling where the stream stands, so the reader notes the
end of every planned batch in ``progress``, a folder beside the query's
checkpoint: after a restart Spark first plans the batch that it had logged (and the
note is written again), or asks for the next one, which then begins at the note. Shards
that appear later are read from their first record.

A micro-batch takes a fixed number of records from each shard, so how many it takes to
drain a log follows its longest shard: a log that grows gets more shards (``shards_for``).
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from recoflow.session import ship
from recoflow.sources.delivery import open_fs

FORMAT = "recoflow_shards"
SCHEMA = "shard string, sequence long, record_id string, data string"
RECORDS_PER_BATCH = 100
BATCHES_PER_SHARD = 2
SEGMENT_RECORDS = 1000
#: A log is given a shard for so many records, and no fewer than MIN_SHARDS.
SHARD_RECORDS = 4000
MIN_SHARDS = 16
_SEGMENT = re.compile(r"(\d+)-(\d+)\.jsonl$")


def segments(path: str) -> dict[str, list[tuple[int, int, str]]]:
    """shard -> [(first, end, file)], in order."""
    store, root = open_fs(path)
    out: dict[str, list[tuple[int, int, str]]] = {}
    if store.get_file_info(root).type != pafs.FileType.Directory:
        return out
    for info in store.get_file_info(pafs.FileSelector(root, recursive=True)):
        found = _SEGMENT.match(info.base_name)
        folder = info.path.rsplit("/", 2)[-2]
        if found and folder.startswith("shard="):
            first = int(found[1])
            out.setdefault(folder[6:], []).append((first, first + int(found[2]), info.path))
    return {shard: sorted(parts) for shard, parts in out.items()}


def append(path: str, shard: str, records: list[tuple[str, str]], first: int | None = None) -> int:
    """Append (record_id, data) pairs as a segment; returns the shard's next sequence."""
    store, root = open_fs(path)
    if first is None:
        first = max((end for _, end, _ in segments(path).get(shard, [])), default=0)
    if records:
        folder = f"{root}/shard={shard}"
        store.create_dir(folder, recursive=True)
        lines = "".join(json.dumps({"record_id": i, "data": d}) + "\n" for i, d in records)
        made = f"{folder}/_{uuid.uuid4().hex}.tmp"
        with store.open_output_stream(made) as out:
            out.write(lines.encode())
        store.move(made, f"{folder}/{first:020d}-{len(records)}.jsonl")
    return first + len(records)


def shards_for(records: int) -> int:
    """Shards for a log of so many records: the micro-batches that drain it do not grow with it."""
    return max(MIN_SHARDS, -(-records // SHARD_RECORDS))


def write_log(records: DataFrame, path: str, prefix: str = "s", segment: int = SEGMENT_RECORDS) -> None:
    """A new log from (record_id, data): a shard per partition, segments written as rows come."""
    ship(records.sparkSession)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, at, held = f"{prefix}{TaskContext.get().partitionId():05d}", 0, []
        for batch in batches:
            for pair in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.append(pair)
                if len(held) == segment:
                    at, held = append(path, shard, held, at), []
        at = append(path, shard, held, at)
        yield pa.RecordBatch.from_pydict({"shard": [shard], "records": [at]})

    records.select("record_id", "data").mapInArrow(write, "shard string, records long").write.format("noop").mode("overwrite").save()


@dataclass
class Batch(InputPartition):
    """Records ``first`` to ``end`` (excluded) of a shard, and the segments that hold them."""

    shard: str
    first: int
    end: int
    files: list[tuple[int, str]]


@dataclass
class Batches(InputPartition):
    """Batches that one task reads, one after the other."""

    batches: list[Batch]


class ShardReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        o = {k.lower(): v for k, v in options.items()}
        self.path, self.progress = o["path"], o["progress"]
        self.size = int(o.get("records_per_batch", RECORDS_PER_BATCH))
        self.batches = int(o.get("batches_per_shard", BATCHES_PER_SHARD))
        self.per_task = int(o.get("batches_per_task", 1))
        self.earliest = o.get("start", "latest").lower() == "earliest"
        self.planned: dict[str, int] | None = None

    def _ends(self) -> dict[str, int]:
        return {shard: parts[-1][1] for shard, parts in segments(self.path).items()}

    # -- the note of what is planned --------------------------------------------------

    def _read_note(self) -> dict[str, int] | None:
        store, root = open_fs(self.progress)
        if store.get_file_info(f"{root}/planned.json").type != pafs.FileType.File:
            return None
        with store.open_input_stream(f"{root}/planned.json") as note:
            return json.loads(note.read())

    def _note(self, planned: dict[str, int]) -> None:
        store, root = open_fs(self.progress)
        store.create_dir(root, recursive=True)
        made = f"{root}/{uuid.uuid4().hex}.tmp"
        with store.open_output_stream(made) as out:
            out.write(json.dumps(planned).encode())
        store.move(made, f"{root}/planned.json")
        self.planned = planned

    # -- the source -------------------------------------------------------------------

    def initialOffset(self) -> dict:
        """Where the query begins; asked once in its life, or again if it stopped before its first batch."""
        start = self._read_note()
        if start is None:
            start = {} if self.earliest else self._ends()
            self._note(start)
        return start

    def latestOffset(self) -> dict:
        if self.planned is None:  # Spark may ask for the latest offset before the first one
            self.planned = self.initialOffset()
        most = self.size * self.batches
        return {shard: min(end, self.planned.get(shard, 0) + most) for shard, end in self._ends().items()}

    def partitions(self, start: dict, end: dict) -> list[Batch | Batches]:
        held, out = segments(self.path), []
        for shard in sorted(end):
            for first in range(start.get(shard, 0), end[shard], self.size):
                last = min(first + self.size, end[shard])
                out.append(Batch(shard, first, last, [(a, f) for a, b, f in held[shard] if a < last and b > first]))
        self._note(end)
        if self.per_task > 1:
            return [Batches(out[at: at + self.per_task]) for at in range(0, len(out), self.per_task)]
        return out

    def read(self, partition: Batch | Batches) -> Iterator[tuple]:
        for batch in partition.batches if isinstance(partition, Batches) else [partition]:
            yield from self._read_batch(batch)

    def _read_batch(self, partition: Batch) -> Iterator[tuple]:
        store, _ = open_fs(self.path)
        for first, file in partition.files:
            skip, end = max(0, partition.first - first), partition.end - first
            with store.open_input_stream(file) as source:
                lines = source.read().split(b"\n", end)[:end]
            for at, line in enumerate(lines[skip:], first + skip):
                if line:
                    record = json.loads(line)
                    yield partition.shard, at, record["record_id"], record["data"]


class ShardSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> ShardReader:
        return ShardReader(dict(self.options))


def read_shard_stream(spark: SparkSession, path: str, progress: str, start: str = "latest",
                      records_per_batch: int = RECORDS_PER_BATCH, batches_per_shard: int = BATCHES_PER_SHARD,
                      batches_per_task: int = 1) -> DataFrame:
    """The log as a stream of (shard, sequence, record_id, data). ``progress``: a folder beside the query's checkpoint.

    Under ``availableNow`` a run takes one micro-batch; a query that is to drain the log uses a processing-time trigger."""
    ship(spark, __name__, "recoflow.sources.delivery")
    spark.dataSource.register(ShardSource)
    return (spark.readStream.format(FORMAT).option("path", path).option("progress", progress).option("start", start)
            .option("records_per_batch", records_per_batch).option("batches_per_shard", batches_per_shard).option("batches_per_task", batches_per_task).load())
