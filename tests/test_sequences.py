"""Sequence model against a plain reading of its rule; blocks and heavy sessions."""

from __future__ import annotations

import collections
import random

import pytest

from recoflow.operators import sequences

SCHEMA = "session string, ts long, id long, item string"


def views(n, seed=1):
    rng = random.Random(seed)
    return [(rng.choice(["heavy"] * 6 + [f"s{k}" for k in range(12)]), rng.randrange(0, 40_000), k, f"i{min(rng.randrange(12), rng.randrange(12))}")
            for k in range(n)]


def plain_contexts(rows):
    by_session = collections.defaultdict(list)
    for r in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        by_session[r[0]].append(r)
    out = []
    for got in by_session.values():
        items = [None, None] + [r[3] for r in got]
        out += [(*r, items[k + 1], items[k]) for k, r in enumerate(got)]
    return out


def plain_next(ctx, wanted, k):
    n3, n2, n1 = collections.Counter(), collections.Counter(), collections.Counter()
    for *_, x, b, a in ctx:
        if x != b:
            n1[x] += 1
            if b is not None:
                n2[b, x] += 1
                if a is not None:
                    n3[a, b, x] += 1
    out = set()
    for a, b in wanted:
        t3 = sum(n for (p, q, _), n in n3.items() if (p, q) == (a, b))
        t2 = sum(n for (q, _), n in n2.items() if q == b)
        scored = []
        for x in n1:
            if n3[a, b, x]:
                scored.append((n3[a, b, x] / t3, 2, x))
            elif n2[b, x]:
                scored.append((0.4 * n2[b, x] / t2, 1, x))
            else:
                scored.append((0.16 * n1[x] / sum(n1.values()), 0, x))
        scored.sort(key=lambda s: (-round(s[0], 12), -s[1], s[2]))
        out |= {(a, b, x, order, round(score, 9), i + 1) for i, (score, order, x) in enumerate(scored[:k])}
    return out


@pytest.mark.parametrize("block", [50, 3600, 10**6])
def test_contexts_do_not_depend_on_blocks(spark, block):
    rows = views(400)
    got = {tuple(r) for r in sequences.contexts(spark.createDataFrame(rows, SCHEMA).repartition(4), block).select("session", "ts", "id", "item", "b", "a").collect()}
    assert got == set(plain_contexts(rows))


@pytest.mark.parametrize("k", [1, 4, 50])
def test_next_items(spark, k):
    rows = views(300, seed=k)
    ctx = sequences.contexts(spark.createDataFrame(rows, SCHEMA).repartition(3), 2000)
    wanted = [("i0", "i1"), ("i1", "i0"), ("i3", "i3"), (None, "i2"), (None, None), ("i9", "i11"), ("nowhere", "nothing"), ("i0", "i1")]
    out = sequences.next_items(ctx, spark.createDataFrame(wanted, "a string, b string"), k)
    got = [(r.a, r.b, r.item_id, r.order, round(r.score, 9), r["rank"]) for r in out.collect()]
    assert len(got) == len(set(got)) and set(got) == plain_next(plain_contexts(rows), set(wanted), k)


def test_nothing(spark):
    none = spark.createDataFrame([], SCHEMA)
    ctx = sequences.contexts(none)
    assert ctx.count() == 0
    assert sequences.next_items(ctx, spark.createDataFrame([("x", "y")], "a string, b string")).count() == 0
