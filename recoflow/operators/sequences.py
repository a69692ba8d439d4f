"""Next-item model on sessions with back-off to shorter contexts (op 79).

A session's views in order give transitions: after the last two items, the next one.
Counts of transitions after two items, after one and after none are mixed by back-off::

    score(x | a, b) = n(a, b, x) / n(a, b)            where n(a, b, x) > 0
                      BACK_OFF   * n(b, x) / n(b)     else, where n(b, x) > 0
                      BACK_OFF^2 * n(x) / n           else

(n over all that follows). A repeated view of the same item (a reload) is no transition.

Scale. A session that holds a large share of all views is split: lags are taken within
blocks of time, and the last two items of earlier blocks are carried over by a window over blocks. Lists are
made per distinct context, not per session, and a context reads as many entries of the shorter
contexts' lists as it may need (k plus those it has already), by equi-joins; no list is read whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recoflow.session import materialize

BACK_OFF = 0.4
BLOCK_SECONDS = 3600


def contexts(views: DataFrame, block_seconds: int = BLOCK_SECONDS) -> DataFrame:
    """(session, ts, id, item, b, a): every view with the item before it (b) and the one before that (a).

    ``views``: session, ts, id (orders views of one second), item; none null."""
    order = Window.partitionBy("session", "block").orderBy("ts", "id")
    v = views.withColumn("block", F.floor(F.col("ts") / block_seconds))
    inner = v.select("*", F.row_number().over(order).alias("n"), F.lag("item", 1).over(order).alias("b"),
                     F.lag("item", 2).over(order).alias("a"), F.lead(F.lit(1)).over(order).isNull().alias("is_last"))
    over_blocks = Window.partitionBy("session").orderBy("block")
    tails = inner.where("is_last").select("session", "block", F.col("item").alias("last"), F.col("b").alias("second"))
    carried = tails.select("session", "block", F.lag("last").over(over_blocks).alias("last"),
                           F.coalesce(F.lag("second").over(over_blocks), F.lag("last", 2).over(over_blocks)).alias("second"))
    first = inner.where("n <= 2").join(carried, ["session", "block"], "left").select(
        "session", "ts", "id", "item", F.when(F.col("n") == 1, F.col("last")).otherwise(F.col("b")).alias("b"),
        F.when(F.col("n") == 1, F.col("second")).otherwise(F.col("last")).alias("a"))
    return inner.where("n > 2").select("session", "ts", "id", "item", "b", "a").unionByName(first)


def transition_counts(ctx: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Counts after two items (a, b, x, n), after one (b, x, n) and after none (x, n); reloads are left out."""
    steps = ctx.where(F.col("b").isNull() | (F.col("item") != F.col("b"))).withColumnRenamed("item", "x")
    n3 = steps.where("a IS NOT NULL AND b IS NOT NULL").groupBy("a", "b", "x").agg(F.count(F.lit(1)).alias("n"))
    n2 = steps.where("b IS NOT NULL").groupBy("b", "x").agg(F.count(F.lit(1)).alias("n"))
    return n3, n2, steps.groupBy("x").agg(F.count(F.lit(1)).alias("n"))


def _lists(counts: DataFrame, keys: list[str], factor: float) -> DataFrame:
    """Scores of a context's items, with each one's place in the context's list."""
    totals = counts.groupBy(*keys).agg(F.sum("n").alias("total"))
    place = Window.partitionBy(*keys).orderBy(F.col("n").desc(), "x")
    return counts.join(totals, keys).select(*keys, "x", (F.lit(factor) * F.col("n") / F.col("total")).alias("score"), F.row_number().over(place).alias("place"))


def _popular(counts: DataFrame, factor: float) -> DataFrame:
    """The same for all items at once: sorted by ranges, numbered within each range, the ranges' sizes added."""
    order = [F.col("n").desc(), F.col("x")]
    ranged = materialize(counts.orderBy(*order).withColumn("range", F.spark_partition_id()))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy("range").agg(F.count(F.lit(1)).alias("size")).select("range", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("before"))
    total = ranged.agg(F.sum("n")).scalar()
    place = F.row_number().over(Window.partitionBy("range").orderBy(*order)) + F.col("before")
    return ranged.join(sizes, "range").select("x", (F.lit(factor) * F.col("n") / total).alias("score"), place.cast("int").alias("place"))


def next_items(ctx: DataFrame, wanted: DataFrame, k: int = 10, back_off: float = BACK_OFF) -> DataFrame:
    """(a, b, item_id, order, score, rank): the k likeliest next items of every wanted context.

    ``wanted``: contexts (a, b), a or both null for short histories."""
    n3, n2, n1 = (materialize(t) for t in transition_counts(ctx))
    want = wanted.select("a", "b").distinct().withColumn("c", F.to_json(F.struct("a", "b")))
    long = _lists(n3, ["a", "b"], 1.0).join(want, ["a", "b"]).select("c", "x", "score", "place")
    have3 = long.groupBy("c").agg(F.count(F.lit(1)).alias("have"))

    def shorter(lists: DataFrame, keys: list[str], have: DataFrame, taken: DataFrame) -> DataFrame:
        """The first entries of a shorter context's list that no longer context holds; at most k."""
        need = want.join(have, "c", "left").withColumn(
            "place", F.explode(F.sequence(F.lit(1), (F.coalesce("have", F.lit(0)) + k).cast("int"))))
        found = need.join(lists, [*keys, "place"]).join(taken.select("c", "x"), ["c", "x"], "left_anti")
        nth = F.row_number().over(Window.partitionBy("c").orderBy("place"))
        return found.select("c", "x", "score", nth.alias("nth")).where(F.col("nth") <= k).drop("nth")

    middle = shorter(_lists(n2, ["b"], back_off), ["b"], have3, long)
    # items after none: an entry is passed over if a longer context holds it, also beyond its first k
    held = long.select("c", "x").unionByName(want.join(n2, "b").select("c", "x")).distinct()
    short = shorter(_popular(n1, back_off ** 2), [], held.groupBy("c").agg(F.count(F.lit(1)).alias("have")), held)
    every = long.select("c", "x", "score", F.lit(2).alias("order")).unionByName(
        middle.select("c", "x", "score", F.lit(1).alias("order"))).unionByName(short.select("c", "x", "score", F.lit(0).alias("order")))
    rank = F.row_number().over(Window.partitionBy("c").orderBy(F.round("score", 12).desc(), F.col("order").desc(), "x"))
    top = every.withColumn("rank", rank).where(F.col("rank") <= k)
    return want.join(top, "c").select("a", "b", F.col("x").alias("item_id"), "order", "score", "rank")
