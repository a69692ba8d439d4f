"""Keyed state as sorted runs: what is written follows the updates, not the state.

The state after a batch is a list of runs, oldest first; a run is a
Parquet folder with at most one row per key, sorted by key. A batch adds
one run, made of its own updates only. When the runs newer than a run hold more
rows than it, it is merged with them, so a row is rewritten at most about
log2(state / batch) times in its life and there are no more than about so
many runs: what is written follows the batches, not the catalogue.

A manifest per batch names its runs; it is written last, so a batch with a
manifest is complete. Runs and manifests are never changed: the replay of a
complete batch does nothing, that of an incomplete one starts again from
the manifest before it and overwrites only what no manifest names. Readers
merge on read, by the rule of the state (``combine``).

Files that the newest ``keep`` manifests do not name are removed after a
batch (``keep`` batches are what a slow reader may lag behind).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recoflow.sources import files

KEEP_MANIFESTS = 10
_MANIFEST = "run string, first long, last long, rows long"


@dataclass(frozen=True)
class Run:
    """Updates of the batches ``first`` to ``last`` (-1: the initial state)."""

    run: str
    first: int
    last: int
    rows: int


def plan_merges(runs: list[Run]) -> int:
    """Index from which on runs are to be merged into one; ``len(runs)`` - 1 if none."""
    newer = 0
    at = len(runs) - 1
    for i in range(len(runs) - 1, -1, -1):
        if newer > runs[i].rows:
            at = i
        newer += runs[i].rows
    return at


class Runs:
    """The state under ``path``; ``initial``: a Parquet table of its ``columns`` that came before batch 0."""

    #: Columns of a run, the key's first.
    columns: tuple[str, ...] = ()
    #: The key's columns.
    key: tuple[str, ...] = ()

    def combine(self, rows: DataFrame) -> DataFrame:
        """Rows of several runs or updates to one row per key; must not depend on how they are grouped."""
        raise NotImplementedError

    def __init__(self, spark: SparkSession, path: str, initial: str | None = None, keep: int = KEEP_MANIFESTS):
        self.spark, self.path, self.initial, self.keep = spark, path.rstrip("/"), initial, max(1, keep)

    # -- reading ---------------------------------------------------------------------

    def batches(self) -> list[int]:
        """Batches whose manifests are there, oldest first."""
        done = [int(n.split("=")[1]) for n in files.subfolders(self.spark, f"{self.path}/manifest")
                if n.startswith("batch_id=")]
        return sorted(b for b in done if files.exists(self.spark, f"{self._manifest(b)}/_SUCCESS"))

    def runs(self, batch_id: int) -> list[Run]:
        """Runs of the state after a batch, oldest first (a missing manifest fails)."""
        rows = self.spark.read.schema(_MANIFEST).json(self._manifest(batch_id)).collect()
        return sorted((Run(**r.asDict()) for r in rows), key=lambda r: r.first)

    def read(self, batch_id: int | None = None) -> DataFrame:
        """The merged state after ``batch_id`` (default: the last complete batch)."""
        if batch_id is None:
            done = self.batches()
            if not done:
                raise FileNotFoundError(f"no state under {self.path}")
            batch_id = done[-1]
        return self._merge(self.runs(batch_id))

    def _table(self, run: Run) -> DataFrame:
        return self.spark.read.parquet(run.run).select(*self.columns)

    def _merge(self, runs: list[Run]) -> DataFrame:
        tables = [self._table(r) for r in runs]
        rows = tables[0]
        for t in tables[1:]:
            rows = rows.unionByName(t)
        return self.combine(rows)

    # -- writing ---------------------------------------------------------------------

    def _manifest(self, batch_id: int) -> str:
        return f"{self.path}/manifest/batch_id={batch_id}"

    def _before(self, batch_id: int) -> list[Run]:
        if batch_id > 0 and files.exists(self.spark, f"{self._manifest(batch_id - 1)}/_SUCCESS"):
            return self.runs(batch_id - 1)
        if batch_id > 0:  # a lost state fails the batch instead of starting empty
            raise FileNotFoundError(f"no state of batch {batch_id - 1} under {self.path}")
        if self.initial is None:
            return []
        return [Run(self.initial, -1, -1, self.spark.read.parquet(self.initial).count())]

    def _write(self, rows: DataFrame, first: int, last: int) -> Run:
        path = f"{self.path}/run/first={first}/last={last}"
        rows.select(*self.columns).sortWithinPartitions(*self.key).write.mode("overwrite").parquet(path)
        return Run(path, first, last, self.spark.read.parquet(path).count())  # by the files' footers

    def apply(self, updates: DataFrame, batch_id: int) -> list[Run]:
        """Add a batch's updates (any number of rows a key); returns what was written."""
        if files.exists(self.spark, f"{self._manifest(batch_id)}/_SUCCESS"):
            return []  # a replay of a complete batch
        runs = [*self._before(batch_id), self._write(self.combine(updates.select(*self.columns)), batch_id, batch_id)]
        written = [runs[-1]]
        while (at := plan_merges(runs)) < len(runs) - 1:
            merged = self._write(self._merge(runs[at:]), runs[at].first, batch_id)
            runs[at:] = [merged]
            written.append(merged)
        for run in written:  # merged at once: no manifest will name it
            if run not in runs:
                files.remove(self.spark, run.run)
        (self.spark.createDataFrame([(r.run, r.first, r.last, r.rows) for r in runs], _MANIFEST)
         .coalesce(1).write.mode("overwrite").json(self._manifest(batch_id)))
        self._remove_old(batch_id)
        return written

    def _remove_old(self, batch_id: int) -> None:
        """Remove manifests older than the kept ones, then the runs that none of those names."""
        done = [b for b in self.batches() if b <= batch_id]
        old, kept = done[:-self.keep], done[-self.keep:]
        if not old:
            return
        named = {r.run for b in kept for r in self.runs(b)}
        gone = {r.run for b in old for r in self.runs(b)} - named - {self.initial}
        for b in old:
            files.remove(self.spark, self._manifest(b))
        for run in sorted(gone):
            files.remove(self.spark, run)
