"""Settings by version (ops 9, 52-55): which settings were valid when.

The settings table changes while streams run. A log keeps every version with the
instant from which it is valid (epoch seconds; until the next one). Reading is
as of an instant, so a micro-batch that is done again uses the settings of its first run, and
events can be fanned out to the backends that were active when they happened.

Layout under ``path``: ``version=<n>/`` with the settings rows and ``valid_from``. Versions
are appended, never changed; one that becomes valid earlier than an older version replaces it
from its instant on.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recoflow.sources import files

VERSION, FROM, TO = "version", "valid_from", "valid_to"


class SettingsLog:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def numbers(self) -> list[int]:
        return sorted(int(n.split("=")[1]) for n in files.subfolders(self.spark, self.path)
                      if n.startswith(f"{VERSION}=") and files.exists(self.spark, f"{self.path}/{n}/_SUCCESS"))

    def append(self, settings: DataFrame, valid_from: int) -> int:
        """Add a version valid from an instant (epoch seconds) on."""
        number = max(self.numbers(), default=-1) + 1
        settings.withColumn(FROM, F.lit(int(valid_from)).cast("long")).write.mode("error").parquet(f"{self.path}/{VERSION}={number}")
        return number

    def rows(self) -> DataFrame:
        """All settings rows with version, valid_from and valid_to (null: still valid)."""
        if not self.numbers():
            raise FileNotFoundError(f"no settings under {self.path}")
        every = self.spark.read.parquet(self.path)
        # a version ends where a later one begins; one that begins no later than a later version is never valid
        spans = every.select(VERSION, FROM).distinct()
        later = spans.select(F.col(VERSION).alias("v2"), F.col(FROM).alias("f2"))
        ends = spans.join(later, F.col("v2") > F.col(VERSION), "left").groupBy(VERSION).agg(F.min("f2").alias(TO))
        return every.join(ends, VERSION).where(F.col(TO).isNull() | (F.col(FROM) < F.col(TO)))

    def as_of(self, instant: int) -> DataFrame:
        """The settings valid at an instant; none before the first version."""
        rows = self.rows()
        return rows.where((F.col(FROM) <= instant) & (F.col(TO).isNull() | (F.col(TO) > instant))).drop(VERSION, FROM, TO)


def targets_as_of(log: SettingsLog, target: str) -> Column:
    """An array (from, to, targets) of the versions' active targets: one value shipped with the plan
    (a few versions with a few backends)."""
    active = log.rows().where((F.col("status") == "active") & F.col(target).isNotNull())
    spans = log.rows().select(VERSION, FROM, TO).distinct()
    lists = active.groupBy(VERSION).agg(F.array_sort(F.collect_list(target)).alias("targets"))
    full = spans.join(lists, VERSION, "left").select(FROM, TO, F.coalesce("targets", F.array().cast("array<string>")).alias("targets"))
    return full.select(F.collect_list(F.struct(FROM, TO, "targets"))).scalar()


def fanout_as_of(rows: DataFrame, log: SettingsLog, time_col: str, target: str, alias: str) -> DataFrame:
    """52/53 as of each row's own time (epoch seconds): every row once per target that was active then.

    Rows from before the first version, of a time without an active backend, or without a time have no target and are left out."""
    t = F.col(time_col)
    valid = F.filter("__versions", lambda v: (v[FROM] <= t) & (v[TO].isNull() | (v[TO] > t)))
    return rows.withColumn("__versions", targets_as_of(log, target)).withColumn(
        alias, F.explode(F.flatten(F.transform(valid, lambda v: v["targets"])))).drop("__versions")


class BatchSettings:
    """A settings reader for micro-batches: the instant of a batch's first run is noted under ``notes``
    before it is used, and every later run of the batch reads the settings as of it."""

    by_batch = True

    def __init__(self, log: SettingsLog, notes: str, clock=time.time):
        self.log, self.notes, self.clock = log, notes.rstrip("/"), clock

    def __call__(self, batch_id: int) -> DataFrame:
        spark, path = self.log.spark, f"{self.notes}/batch_id={batch_id}"
        if not files.exists(spark, f"{path}/_SUCCESS"):
            spark.createDataFrame([(int(self.clock()),)], "instant long").coalesce(1).write.mode("overwrite").json(path)
        return self.log.as_of(spark.read.schema("instant long").json(path).first().instant)
