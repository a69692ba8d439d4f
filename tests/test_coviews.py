"""Incremental co-views equal a full run after any sequence of days; the work follows the pairs touched."""

from __future__ import annotations

import collections
import itertools
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from recoflow.operators import coviews, scoring
from recoflow.operators.coviews import CoViews, changed_pairs

SCHEMA = "day long, u string, i string"


def full(views):
    counts = collections.Counter()
    by_user = collections.defaultdict(set)
    for _, u, i in views:
        by_user[u].add(i)
    for items in by_user.values():
        counts.update(itertools.permutations(sorted(items), 2))
    return {(i, j, n) for (i, j), n in counts.items()}


def rows(df):
    got = [tuple(r) for r in df.collect()]
    assert len(got) == len(set(got))
    return set(got)


@pytest.mark.parametrize("block_items", [2, 2048])
def test_any_sequence_of_days(spark, block_items):
    rng = random.Random(block_items)
    days = {d: {(d, f"u{rng.choice([0, 0, 0, 1, 2, 3, 4])}", f"i{rng.randrange(9)}") for _ in range(25)} for d in range(5)}
    state = CoViews(spark, tempfile.mkdtemp(prefix="coviews-"), block_items)
    steps = [((0, 1), ()), ((2,), (0,)), ((), (1,)), ((3, 4, 0), (2,)), ((), (3, 4, 0))]
    window = set()
    for number, (come, go) in enumerate(steps):
        frame = lambda ds: spark.createDataFrame([v for d in ds for v in days[d]], SCHEMA)
        state.step(number, frame(come), frame(go))
        window = (window | set(come)) - set(go)
        views = [v for d in window for v in days[d]]
        assert rows(state.counts()) == full(views)
        if number == 1:
            state.step(number, frame(come), frame(go))  # repeated: nothing changes
            assert rows(state.counts()) == full(views)
            inter = spark.createDataFrame([(u, i, d * 86400) for d, u, i in views], "USER_ID string, ITEM_ID string, TIMESTAMP long")
            assert rows(state.similar_items()) == rows(scoring.similar_items(inter))


def test_the_work_follows_the_pairs_touched(spark):
    """A user with many items who gains one makes that item's pairs, and a user who is not touched none."""
    own = spark.createDataFrame([(u, f"i{k}") for u in ("big", "other") for k in range(300)], "u string, i string")
    changed = spark.createDataFrame([("big", "i7")], "u string, i string")
    out = changed_pairs(changed, own, -1, block_items=50).collect()
    assert len(out) == 299 and {r.users for r in out} == {-1} and all("i7" in (r.a, r.b) for r in out)


def test_day_views(spark):
    inter = spark.createDataFrame([("u", "i", 86400), ("u", "i", 86401), ("u", "i", 172800), (None, "i", 5), ("u", None, 5), ("v", "j", -1)],
                                  "USER_ID string, ITEM_ID string, TIMESTAMP long")
    assert rows(coviews.day_views(inter)) == {(1, "u", "i"), (2, "u", "i"), (-1, "v", "j")}
    assert rows(coviews.day_views(inter.where("false"))) == set()
    assert changed_pairs(coviews.day_views(inter).select("u", "i").where("false"), coviews.day_views(inter).select("u", "i"), 1).agg(F.count("a")).first()[0] == 0
