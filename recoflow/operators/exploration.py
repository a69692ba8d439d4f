"""Exploration of fresh items in recommendation lists (op 79).

A share ``weight`` of a list's places is given to fresh items (created within the
age cut-off) that the model cannot know yet. Everything is drawn from seeded
hashes, so a request and a seed always give the same list:

* place p of a request is explored when ``u(seed, request, p) < weight``;
* fresh items are sampled without replacement by Gumbel keys
  ``ln w - ln(-ln u(seed, pool, item))``: taking the largest keys draws items with
  probabilities proportional to their weights w, one after another. A request reads the
  order of its pool, one of ``pools``, so the keys are pools x fresh items, whatever the
  number of requests;
* items that the list holds already or that the user has seen are passed over.

The other places keep the ranked list's order, as do explored places for which
no fresh item is left. A request reads as many entries of its pool as it explores, plus
as many as it must pass over: an equi-join on (pool, entry), no product.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recoflow import constants as C
from recoflow.functions.columns import midnight_epoch

POOLS = 512
_HEX = 13  # hexadecimal digits of a hash that make a number: 52 bits


def uniform(seed: str, *parts: Column) -> Column:
    """A number in (0, 1) from md5 of ``seed|part|...``; any engine with md5 can state it."""
    text = F.concat_ws("|", F.lit(seed), *(p.cast("string") for p in parts))
    return (F.conv(F.substring(F.md5(text), 1, _HEX), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 4 * _HEX))


def pool_of(seed: str, request: Column, pools: int) -> Column:
    return F.floor(uniform(seed, F.lit("pool"), request) * pools).cast("int")


def fresh_items(items: DataFrame, as_of, max_age: int = C.EXPLORATION_AGE_SECONDS) -> DataFrame:
    """(item_id) created within ``max_age`` seconds before ``as_of`` and not flagged to be left out."""
    age = midnight_epoch(as_of, 0) - F.col("CREATION_TIMESTAMP")
    return items.where((age <= max_age) & (F.coalesce("Exclude", F.lit(0)) != 1)).select(
        F.col("ITEM_ID").alias("item_id")).distinct()


def pool_orders(fresh: DataFrame, seed: str, pools: int = POOLS) -> DataFrame:
    """(pool, entry, item_id): the fresh items of each pool by falling Gumbel key; ``fresh``: item_id and, if it has one, w > 0."""
    w = F.col("w") if "w" in fresh.columns else F.lit(1.0)
    u = uniform(seed, F.lit("item"), F.col("pool"), F.col("item_id"))
    keyed = fresh.withColumn("pool", F.explode(F.sequence(F.lit(0), F.lit(pools - 1)))).withColumn("g", F.log(w) - F.log(-F.log(u)))
    order = Window.partitionBy("pool").orderBy(F.col("g").desc(), "item_id")
    return keyed.select("pool", F.row_number().over(order).alias("entry"), "item_id")


def explore(requests: DataFrame, ranked: DataFrame, fresh: DataFrame, viewed: DataFrame, seed: str,
            weight: float = C.EXPLORATION_WEIGHT, pools: int = POOLS) -> DataFrame:
    """Lists with fresh items mixed in: (request_id, position, item_id, explored).

    ``requests``: request_id, user_id, k (places); ``ranked``: request_id, item_id, rank (from 1);
    ``viewed``: user_id, item_id.
    """
    request = F.col("request_id")
    drawn = requests.select("request_id", "user_id", "k", pool_of(seed, request, pools).alias("pool"), F.filter(
        F.sequence(F.lit(1), F.greatest("k", F.lit(1))),
        lambda p: (p <= F.col("k")) & (uniform(seed, F.lit("place"), request, p) < weight)).alias("places"))
    new = fresh.select("item_id").distinct()
    listed = ranked.join(new, "item_id", "left_semi").select("request_id", "item_id")
    seen = requests.select("request_id", "user_id").join(viewed.join(new, "item_id", "left_semi"), "user_id").select("request_id", "item_id")
    blocked = listed.unionByName(seen).distinct()
    most = drawn.join(blocked.groupBy("request_id").agg(F.count(F.lit(1)).alias("n_blocked")), "request_id", "left").where(
        F.size("places") > 0).select("request_id", "pool", F.size("places").alias("n"), F.explode(F.sequence(
            F.lit(1), F.size("places") + F.coalesce("n_blocked", F.lit(0)).cast("int"))).alias("entry"))
    free = most.join(pool_orders(fresh, seed, pools), ["pool", "entry"]).join(blocked, ["request_id", "item_id"], "left_anti")
    nth = F.row_number().over(Window.partitionBy("request_id").orderBy("entry"))
    chosen = free.withColumn("nth", nth).where(F.col("nth") <= F.col("n")).select("request_id", "nth", "item_id")
    # the first places explored take what there is; the ranked list fills the others
    filled = drawn.join(chosen.groupBy("request_id").agg(F.max("nth").alias("m")), "request_id", "left").select(
        "request_id", F.slice("places", F.lit(1), F.coalesce("m", F.lit(0))).alias("used"), "k")
    new_rows = chosen.join(filled, "request_id").select(
        "request_id", F.get("used", F.col("nth") - 1).alias("position"), "item_id", F.lit(True).alias("explored"))
    left = F.array_except(F.sequence(F.lit(1), F.greatest("k", F.lit(1))), F.col("used"))
    old_rows = ranked.select("request_id", "item_id", "rank").join(filled, "request_id").select(
        "request_id", "k", F.get(left, F.col("rank").cast("int") - 1).alias("position"), "item_id", F.lit(False).alias("explored")).where(
        F.col("position") <= F.col("k")).drop("k")
    return new_rows.unionByName(old_rows)
