"""Exploration: repeatable lists, shares that match the weight, weighted draws without replacement, nothing seen or listed twice."""

from __future__ import annotations

import collections
import hashlib
import math

from pyspark.sql import functions as F

from recoflow.operators import exploration as ex
from recoflow.operators.exploration import explore


def u(*parts):
    return (int(hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()[:13], 16) + 0.5) / 2**52


def brute(requests, ranked, fresh, viewed, seed, weight, pools):
    out = set()
    for r, user, k in requests:
        pool = int(u(seed, "pool", r) * pools)
        places = [p for p in range(1, k + 1) if u(seed, "place", r, p) < weight]
        listed = [i for q, i, _ in sorted(ranked, key=lambda x: x[2]) if q == r]
        order = sorted(fresh, key=lambda f: (-(math.log(f[1]) - math.log(-math.log(u(seed, "item", pool, f[0])))), f[0]))
        free = [i for i, _ in order if i not in listed and (user, i) not in viewed]
        new = dict(zip(places, free))
        out |= {(r, p, i, True) for p, i in new.items()}
        rest = [p for p in range(1, k + 1) if p not in new]
        out |= {(r, p, i, False) for p, i in zip(rest, listed)}
    return out


def tables(spark, n=200, k=10, n_fresh=40):
    requests = [(f"r{i}", f"u{i % 20}", k if i % 9 else i % 4) for i in range(n)]
    ranked = [(f"r{i}", f"i{(i + 3 * j) % 60}", j + 1) for i in range(n) for j in range(i % 12)]
    fresh = [(f"i{j}", 1.0 + (j % 3)) for j in range(30, 30 + n_fresh)]
    viewed = [(f"u{a}", f"i{b}") for a in range(20) for b in range(30 + a, 70, 7)]
    frames = (spark.createDataFrame(requests, "request_id string, user_id string, k int"), spark.createDataFrame(ranked, "request_id string, item_id string, rank int"),
              spark.createDataFrame(fresh, "item_id string, w double"), spark.createDataFrame(viewed, "user_id string, item_id string"))
    return (requests, ranked, fresh, set(viewed)), frames


def rows(df):
    got = [tuple(r) for r in df.select("request_id", "position", "item_id", "explored").collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_lists_equal_the_plain_rule_and_repeat(spark):
    for n_fresh in (40, 3):
        plain, frames = tables(spark, n_fresh=n_fresh)
        got = rows(explore(*frames, seed="s1", pools=8))
        assert got == brute(*plain, "s1", 0.3, 8)
        assert got == rows(explore(*(f.repartition(3) for f in frames), seed="s1", pools=8))
        assert got != rows(explore(*frames, seed="s2", pools=8))
    places = collections.Counter((r, p) for r, p, _, _ in got)
    assert max(places.values()) == 1


def test_shares_match_the_weight(spark):
    requests = spark.range(4000).select(F.col("id").cast("string").alias("request_id"), F.lit("u").alias("user_id"), F.lit(20).alias("k"))
    ranked = requests.select("request_id", F.explode(F.sequence(F.lit(1), F.lit(20))).alias("rank")).withColumn("item_id", F.concat(F.lit("old"), "rank"))
    fresh = spark.range(100).select(F.concat(F.lit("new"), "id").alias("item_id"))
    none = spark.createDataFrame([], "user_id string, item_id string")
    out = explore(requests, ranked, fresh, none, "s")
    share, n = out.agg(F.avg(F.col("explored").cast("double")), F.count(F.lit(1))).first()
    assert n == 4000 * 20 and abs(share - 0.3) < 4 * math.sqrt(0.3 * 0.7 / n)
    first = out.where("NOT explored").groupBy("request_id").agg(F.max("item_id").alias("x"), F.count(F.lit(1)).alias("n"))
    assert first.count() == 4000


def test_first_draws_follow_the_weights(spark):
    fresh = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 5.0)], "item_id string, w double")
    n = 20_000
    first = {r.item_id: r.n for r in ex.pool_orders(fresh, "seed", n).where("entry = 1").groupBy("item_id").agg(F.count(F.lit(1)).alias("n")).collect()}
    for item, w in (("a", 1), ("b", 2), ("c", 5)):
        p = w / 8
        assert abs(first[item] / n - p) < 4 * math.sqrt(p * (1 - p) / n)


def test_empty_inputs(spark):
    _, (requests, ranked, fresh, viewed) = tables(spark, n=5)
    assert rows(explore(requests.where("false"), ranked.where("false"), fresh, viewed, "s")) == set()
    alone = rows(explore(requests, ranked, fresh.where("false"), viewed, "s"))
    assert {r[3] for r in alone} <= {False}
