"""Snapshots by manifest, settings by version, field flags, plain partition predicates, tables that are not replaced in place."""

from __future__ import annotations

import datetime
import os
import random
import re
import tempfile
import threading

import pytest
from pyspark.sql import functions as F

from recoflow import schemas
from recoflow.operators import settings_log
from recoflow.operators.settings_log import BatchSettings, SettingsLog
from recoflow.operators.validate import split, validate_dataset
from recoflow.registry import INGEST_EPOCH
from recoflow.sources import fixtures as fx
from recoflow.sources import readers, snapshots, writers
from recoflow.streaming import ingest
from tests.conftest import SMALL, S, rows

ITEMS = "ITEM_ID string, ContentText string"


def frame(spark, *names):
    return spark.createDataFrame([(n, f'said "{n}",\nthené') for n in names], ITEMS)


# -- snapshots ------------------------------------------------------------------------

def test_datasets_resolve_to_one_version(spark):
    dest = tempfile.mkdtemp(prefix="snapshots-")
    schema = frame(spark, "x").schema
    with pytest.raises(FileNotFoundError):
        snapshots.manifest(spark, dest)
    assert snapshots.publish(spark, {"a": frame(spark, "x"), "b": frame(spark, "x")}, dest) == 1
    assert snapshots.publish(spark, {"a": frame(spark, "y", "y"), "b": frame(spark, "z")}, dest) == 2  # within the same second
    lost = snapshots.claim_version(spark, dest)  # a publish that failed after one dataset
    writers.write_csv(frame(spark, "half"), f"{dest}/a/v={lost:012d}")
    got = snapshots.read(spark, dest, {"a": schema, "b": schema})
    assert [r.ITEM_ID for r in got["a"].collect()] == ["y", "y"] and got["b"].first().ITEM_ID == "z"
    old = snapshots.read(spark, dest, {"a": schema, "b": schema}, version=1)
    assert {d.first().ITEM_ID for d in old.values()} == {"x"}
    assert snapshots.publish(spark, {"a": frame(spark, "w")}, dest) == 4 and snapshots.versions(spark, dest) == [1, 2, 4]
    with pytest.raises(KeyError, match="b"):
        snapshots.read(spark, dest, {"a": schema, "b": schema})


def test_damaged_files_are_refused(spark):
    schema = frame(spark, "x").schema
    for damage in ("lost", "changed", "twice"):
        dest = tempfile.mkdtemp(prefix="snapshots-damaged-")
        snapshots.publish(spark, {"a": frame(spark, "x", "y", "z").repartition(3)}, dest)
        folder = f"{dest}/a/v=000000000001"
        part = sorted(f for f in os.listdir(folder) if f.endswith(".csv") and os.path.getsize(f"{folder}/{f}") > 30)[0]
        for crc in [f for f in os.listdir(folder) if f.endswith(".crc")]:
            os.remove(f"{folder}/{crc}")
        text = open(f"{folder}/{part}").read()
        if damage == "lost":
            os.remove(f"{folder}/{part}")
        elif damage == "changed":
            open(f"{folder}/{part}", "w").write(text.replace("then", "than"))
        else:
            open(f"{folder}/more.csv", "w").write(text)
        with pytest.raises(ValueError, match="damaged"):
            snapshots.read(spark, dest, {"a": schema})
        assert snapshots.read(spark, dest, {"a": schema}, check=False)["a"].count() in (2, 3, 4)


def test_checksum_is_free_of_order_and_counts_repeats(spark):
    df = frame(spark, *map(str, range(50)))
    total = lambda d: d.agg(snapshots.checksum(d.columns)).first()[0]
    assert total(df) == total(df.repartition(7).orderBy(F.desc("ITEM_ID")))
    assert total(df) != total(df.unionAll(df.limit(1))) and total(df.where("false")) == "0"


def test_publishers_at_the_same_time_get_numbers_of_their_own(spark):
    dest, got = tempfile.mkdtemp(prefix="snapshots-race-"), []
    threads = [threading.Thread(target=lambda: got.append(snapshots.claim_version(spark, dest))) for _ in range(12)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(got) == list(range(1, 13))


def test_retention_spares_versions_in_use(spark):
    dest = tempfile.mkdtemp(prefix="snapshots-retain-")
    schema = frame(spark, "x").schema
    for k in range(5):
        snapshots.publish(spark, {"a": frame(spark, f"v{k}")}, dest)
    held = snapshots.hold(spark, dest, 2)
    assert snapshots.retain(spark, dest, 2) == [1, 3]
    assert snapshots.versions(spark, dest) == [2, 4, 5] and not os.path.exists(f"{dest}/a/v=000000000003")
    assert snapshots.read(spark, dest, {"a": schema}, version=2)["a"].first().ITEM_ID == "v1"
    snapshots.release(spark, held)
    assert snapshots.retain(spark, dest, 2) == [2]
    with pytest.raises(FileNotFoundError):
        snapshots.hold(spark, dest, 2)


# -- sinks ------------------------------------------------------------------------------

def test_a_failed_write_leaves_the_old_dataset(spark):
    path = tempfile.mkdtemp(prefix="sink-") + "/out"
    writers.write_items(frame(spark, "old"), path)
    broken = frame(spark, "new").withColumn("ContentText", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        writers.write_items(broken, path)
    assert writers.read_csv(spark, path, frame(spark, "x").schema).first().ITEM_ID == "old"
    writers.write_items(frame(spark, "new"), path)
    assert writers.read_csv(spark, path, frame(spark, "x").schema).collect()[0].ITEM_ID == "new"


def test_managed_tables_are_refused(spark):
    spark.sql("DROP TABLE IF EXISTS recoflow_managed_test")
    spark.range(3).write.saveAsTable("recoflow_managed_test")
    try:
        with pytest.raises(ValueError, match="external"):
            writers.write_interactions(frame(spark, "x"), tempfile.mkdtemp() + "/t", table="recoflow_managed_test")
        assert spark.table("recoflow_managed_test").count() == 3
    finally:
        spark.sql("DROP TABLE recoflow_managed_test")


# -- partitions ---------------------------------------------------------------------------

def test_rolling_month_is_plain_comparisons_and_prunes(spark):
    base = tempfile.mkdtemp(prefix="month-") + "/raw"
    days = [datetime.date(2023, 11, 1) + datetime.timedelta(days=k) for k in range(150)]
    spark.createDataFrame([(d.year, d.month, d.day, "x") for d in days], "year int, month int, day int, v string").write.partitionBy(
        "year", "month", "day").parquet(base)
    rng = random.Random(1)
    for as_of in [datetime.date(2024, 1, 31), datetime.date(2024, 3, 30), datetime.date(2024, 3, 31), *rng.sample(days[40:], 4)]:
        df = readers.read_raw_events(spark, base, as_of.isoformat())
        got = {datetime.date(r.year, r.month, r.day) for r in df.collect()}
        end = F.lit(as_of)
        want = {r.d for r in spark.createDataFrame([(d,) for d in days], "d date").where((F.col("d") > F.add_months(end, -1)) & (F.col("d") <= end)).collect()}
        assert got == want
    plan = df._jdf.queryExecution().executedPlan().toString()
    filters = re.search(r"PartitionFilters: \[([^\]]*)\]", plan)[1]
    assert "make_date" not in filters and "year" in filters and "day" in filters


# -- field flags -----------------------------------------------------------------------------

def test_flags_survive_checks_casts_and_files(spark):
    declared = {"type": "record", "name": "x", "fields": [
        {"name": "ITEM_ID", "type": "string"}, {"name": "WordCount", "type": ["int", "null"]},
        {"name": "ContentText", "type": ["null", "string"], "textual": True}, {"name": "Category", "type": ["string", "null"], "categorical": True}]}
    schema = schemas.dataset_schema(declared)
    assert [schemas.flag_of(f) for f in schema] == [None, None, "textual", "categorical"]
    assert [f.nullable for f in schema] == [False, True, True, True]
    df = spark.createDataFrame([("a", "7", "text", None), ("b", "x", None, "c")], "ITEM_ID string, WordCount string, ContentText string, Category string")
    valid, rejected = split(validate_dataset(df, schema))
    assert [r.skip_reason for r in rejected.collect()] == ["bad WordCount"]
    base = tempfile.mkdtemp(prefix="flags-")
    valid.write.parquet(f"{base}/p")
    writers.write_csv(valid, f"{base}/c")
    for back in (spark.read.parquet(f"{base}/p"), writers.read_csv(spark, f"{base}/c", schema), valid.select("Category", "ContentText", "ITEM_ID", "WordCount")):
        assert {f.name: schemas.flag_of(f) for f in back.schema.fields} == {"ITEM_ID": None, "WordCount": None, "ContentText": "textual", "Category": "categorical"}
        assert back.count() == 1
    with pytest.raises(KeyError):
        schemas.dataset_schema({"fields": [{"name": "x", "type": "bytes"}]})
    assert sum(schemas.flag_of(f) == "categorical" for f in schemas.INTERACTIONS) == 5


# -- settings ------------------------------------------------------------------------------------

SETTINGS = "name string, status string, eventTrackerId string"


def test_settings_as_of_an_instant(spark):
    log = SettingsLog(spark, tempfile.mkdtemp(prefix="settings-"))
    with pytest.raises(FileNotFoundError):
        log.as_of(0)
    version = lambda *t: spark.createDataFrame([(x, "active", x) for x in t], SETTINGS)
    log.append(version("a", "b"), 100)
    log.append(version("b"), 200)
    log.append(version("c"), 300)
    log.append(version("d"), 250)  # replaces c, which was to come, and b from 250 on
    names = lambda t: {r.name for r in log.as_of(t).collect()}
    assert [names(t) for t in (99, 100, 199, 200, 249, 250, 300, 9999)] == [set(), {"a", "b"}, {"a", "b"}, {"b"}, {"b"}, {"d"}, {"d"}, {"d"}]
    events = spark.createDataFrame([(k, t) for k, t in enumerate((0, 100, 220, 260, None))], "id long, at long")
    out = settings_log.fanout_as_of(events, log, "at", "eventTrackerId", "target")
    assert rows(out, "id", "target") == S([(1, "a"), (1, "b"), (2, "b"), (3, "d")])


def test_a_replay_after_a_change_of_settings_gives_the_first_runs_records(spark):
    base, clock = tempfile.mkdtemp(prefix="settings-replay-"), [1000]
    log = SettingsLog(spark, f"{base}/settings")
    log.append(fx.settings(spark, SMALL), 0)
    reader = BatchSettings(log, f"{base}/notes", clock=lambda: clock[0])
    w = ingest.event_batch_writer(reader, f"{base}/out", F.lit(INGEST_EPOCH))
    events = fx.stream_event_json(spark, SMALL)
    w(events, 0)
    first = rows(spark.read.parquet(f"{base}/out/records/batch_id=0"))
    clock[0] = 2000
    log.append(fx.settings(spark, SMALL).withColumn("eventTrackerId", F.concat(F.lit("new-"), "eventTrackerId")), 1500)
    w(events, 0)  # done again after the change
    assert rows(spark.read.parquet(f"{base}/out/records/batch_id=0")) == first
    w(events, 1)
    second = spark.read.parquet(f"{base}/out/records/batch_id=1")
    assert second.where("trackingId NOT LIKE 'new-%'").count() == 0 and second.count() == len(first)
