"""Item state as runs: what is written, replays around a merge, removal of old files."""

from __future__ import annotations

import math
import os
import random
import tempfile

import pytest

from recoflow.streaming import runs as runs_module
from recoflow.streaming.item_state import ItemState
from recoflow.streaming.runs import Run, plan_merges

SCHEMA = "itemId string, updated_ts long, record_id string, properties string"


def batches(n: int, size: int, items: int, seed: int = 1):
    rng = random.Random(seed)
    return [[(f"i{rng.randrange(items)}", rng.randrange(50), f"r{b}-{k}", f"p{b}.{k}") for k in range(size)] for b in range(n)]


def newest(rows):
    best = {}
    for row in rows:
        best[row[0]] = max(best.get(row[0], row), row, key=lambda r: (r[1], r[2], r[3]))
    return set(best.values())


def content(df):
    got = [tuple(r) for r in df.select("itemId", "updated_ts", "record_id", "properties").collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_plan_merges():
    runs = lambda *rows: [Run(str(i), i, i, n) for i, n in enumerate(rows)]
    assert plan_merges(runs(5)) == 0 and plan_merges(runs(5, 5)) == 1
    assert plan_merges(runs(5, 5, 5)) == 0 and plan_merges(runs(100, 5, 5, 5)) == 1
    assert plan_merges(runs(100, 0)) == 1 and plan_merges(runs(0, 1)) == 0


def test_state_is_that_of_all_updates_and_writes_follow_the_batches(spark):
    path = tempfile.mkdtemp(prefix="item-state-")
    start = [(f"i{k}", 10, "old", "old") for k in range(5000)]
    spark.createDataFrame(start, SCHEMA).write.parquet(f"{path}/start")
    state = ItemState(spark, f"{path}/state", initial=f"{path}/start", keep=3)
    rows, written, most = list(start), 0, 0
    every = batches(12, 6, 6000)
    for b, batch in enumerate(every):
        out = state.apply(spark.createDataFrame(batch, SCHEMA), b)
        rows += batch
        written += sum(r.rows for r in out)
        most = max(most, len(state.runs(b)))
        if b % 3 == 2:
            assert content(state.read()) == newest(rows)
    assert all(not r.run.endswith("/start") or r.first == -1 for r in state.runs(11))
    # each row is rewritten about log2(batches) times at most, and never with the 5,000 that were there before
    assert written <= 12 * 6 * (math.log2(12) + 1) and most <= 2 + math.log2(12)
    assert state.batches() == [9, 10, 11]
    named = {r.run for b in state.batches() for r in state.runs(b)} - {f"{path}/start"}
    left = {os.path.join(d, n) for d, names, _ in os.walk(f"{path}/state/run") for n in names if n.startswith("last=")}
    assert left == named and os.path.exists(f"{path}/start/_SUCCESS")


@pytest.mark.parametrize("fails_in", ["manifest", "merge", None])
def test_replays_around_a_merge(spark, monkeypatch, fails_in):
    """A batch that stops before its manifest is done again; one that is complete is left alone."""
    path = tempfile.mkdtemp(prefix="item-replay-")
    state = ItemState(spark, path, keep=2)
    every = batches(6, 4, 10, seed=2)
    rows = []
    for b, batch in enumerate(every):
        df = spark.createDataFrame(batch, SCHEMA)
        if fails_in:
            with monkeypatch.context() as m:
                if fails_in == "manifest":
                    m.setattr(ItemState, "_manifest", _breaking(ItemState._manifest, b))
                else:
                    m.setattr(ItemState, "_merge", _stop)
                    m.setattr(runs_module, "plan_merges", lambda runs: 0)
                try:
                    state.apply(df, b)
                except RuntimeError:
                    assert b - 1 in state.batches() or b == 0
                    assert b not in state.batches()
        state.apply(df, b)
        rows += batch
        once = content(state.read(b))
        assert once == newest(rows)
        assert state.apply(spark.createDataFrame(batch * 2, SCHEMA), b) == []
        assert content(state.read(b)) == once
        if b:
            assert content(state.read(b - 1)) == newest(rows[:-4])  # still readable


def _breaking(whole, batch):
    calls = []

    def manifest(self, b):
        calls.append(b)
        if b == batch and calls.count(batch) > 1:
            raise RuntimeError("lost")
        return whole(self, b)
    return manifest


def _stop(self, runs):
    raise RuntimeError("lost")


def test_a_lost_state_fails_the_batch(spark):
    state = ItemState(spark, tempfile.mkdtemp(prefix="item-lost-"))
    with pytest.raises(FileNotFoundError):
        state.read()
    with pytest.raises(FileNotFoundError):
        state.apply(spark.createDataFrame([], SCHEMA), 4)


def test_empty_batches(spark):
    state = ItemState(spark, tempfile.mkdtemp(prefix="item-empty-"))
    none = spark.createDataFrame([], SCHEMA)
    for b in range(3):
        state.apply(none, b)
    assert state.read().count() == 0
    state.apply(spark.createDataFrame([("a", 1, "r", None), (None, 2, "r", "x")], SCHEMA), 3)
    assert content(state.read()) == {("a", 1, "r", None), (None, 2, "r", "x")}
