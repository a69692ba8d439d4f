"""Incremental co-view counts (op 78): days come into the window and go out of it.

State (``streaming.runs``): the number of days of the window on which a user
viewed an item, and the number of users that viewed both items of a pair. A
step adds the views of some days and takes off those of others. Only (user, item)
pairs that appear or vanish change counts: with S the user's items before, A those that
appear, X those that vanish and S' = S + A - X, pairs of A with S' are added and pairs of X with
S are taken off. Pairs are built for the users that the step touches only; of them, one side is
always what has changed. A heavy user's items are dealt to blocks of at most ``block_items``, on
both sides, so no task holds more than the product of two blocks. The result equals a full run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recoflow import constants as C
from recoflow.operators import scoring
from recoflow.operators.scoring import DEFAULT_BLOCK_ITEMS
from recoflow.session import materialize
from recoflow.streaming.runs import Runs


class ViewDays(Runs):
    """(u, i, days): in how many days of the window the user viewed the item."""

    columns = ("u", "i", "days")
    key = ("u", "i")

    def combine(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy("u", "i").agg(F.sum("days").alias("days")).where("days <> 0")


class PairCounts(Runs):
    """(a, b, users), a < b: users that viewed both."""

    columns = ("a", "b", "users")
    key = ("a", "b")

    def combine(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy("a", "b").agg(F.sum("users").alias("users")).where("users <> 0")


def day_views(interactions: DataFrame) -> DataFrame:
    """(day, u, i): the distinct views of every day (days since the epoch)."""
    return interactions.where(F.col("USER_ID").isNotNull() & F.col("ITEM_ID").isNotNull()).select(
        F.floor(F.col("TIMESTAMP") / 86400).cast("long").alias("day"), F.col("USER_ID").alias("u"), F.col("ITEM_ID").alias("i")).distinct()


def changed_pairs(changed: DataFrame, own: DataFrame, sign: int, block_items: int = DEFAULT_BLOCK_ITEMS) -> DataFrame:
    """(a, b, users): ``sign`` for every pair of an item of ``changed`` (u, i) with another one
    of the same user's ``own`` (u, i; holds ``changed``), summed over users."""
    sizes = own.groupBy("u").agg(F.count(F.lit(1)).alias("d"))
    many = changed.groupBy("u").agg(F.count(F.lit(1)).alias("e"))
    blocks = sizes.join(many, "u").select("u", *(F.greatest(F.lit(1), F.ceil(F.col(x) / F.lit(block_items)).cast("int")).alias(y)
                                                 for x, y in (("d", "nd"), ("e", "ne"))))

    def dealt(items: DataFrame, own_blocks: str, other_blocks: str, own_block: str, other_block: str) -> DataFrame:
        return items.join(blocks, "u").select(
            "u", "i", F.pmod(F.xxhash64("i"), F.col(own_blocks).cast("long")).cast("int").alias(own_block),
            F.explode(F.sequence(F.lit(0), F.col(other_blocks) - 1)).alias(other_block))

    inside = changed.select("u", F.col("i").alias("j"), F.lit(True).alias("new"))
    left = dealt(changed, "ne", "nd", "bl", "br")
    right = dealt(own, "nd", "ne", "br", "bl").withColumnRenamed("i", "j").join(inside, ["u", "j"], "left")
    # a pair with both items changed comes twice: once is enough
    pairs = left.join(right, ["u", "bl", "br"]).where((F.col("i") != F.col("j")) & (F.col("new").isNull() | (F.col("i") < F.col("j"))))
    return pairs.groupBy(F.least("i", "j").alias("a"), F.greatest("i", "j").alias("b")).agg(
        (F.count(F.lit(1)) * sign).cast("long").alias("users"))


class CoViews:
    """The counts under ``path``; steps are numbered from 0 and may be repeated after a failure."""

    def __init__(self, spark: SparkSession, path: str, block_items: int = DEFAULT_BLOCK_ITEMS):
        self.spark, self.block_items = spark, block_items
        self.days, self.pairs = ViewDays(spark, f"{path}/days"), PairCounts(spark, f"{path}/pairs")

    def step(self, number: int, added: DataFrame, expired: DataFrame) -> None:
        """``added``, ``expired``: rows of ``day_views`` of the days that come in and go out."""
        moved = added.select("u", "i", F.lit(1).cast("long").alias("days")).unionByName(
            expired.select("u", "i", F.lit(-1).cast("long").alias("days")))
        moved = materialize(self.days.combine(moved))
        users = moved.select("u").distinct()
        if number:
            before = self.days.read(number - 1).join(users, "u", "left_semi")
        else:
            before = moved.where("false")
        both = before.select("u", "i", "days", F.lit(0).cast("long").alias("move")).unionByName(
            moved.select("u", "i", F.lit(0).cast("long").alias("days"), F.col("days").alias("move")))
        # the items of the users touched, with their days before and after
        both = materialize(both.groupBy("u", "i").agg(F.sum("days").alias("was"), F.sum(F.col("days") + F.col("move")).alias("now")))
        old, new = both.where("was > 0").select("u", "i"), both.where("now > 0").select("u", "i")
        appeared = both.where("was <= 0 AND now > 0").select("u", "i")
        vanished = both.where("was > 0 AND now <= 0").select("u", "i")
        changes = changed_pairs(appeared, new, 1, self.block_items).unionByName(changed_pairs(vanished, old, -1, self.block_items))
        self.pairs.apply(changes, number)
        self.days.apply(moved, number)  # last: the days of a step are there only with its pairs

    def counts(self, number: int | None = None) -> DataFrame:
        """(i, j, c_ij) for i != j, as ``scoring.co_view_counts``."""
        both = F.array(F.struct(F.col("a").alias("i"), F.col("b").alias("j")), F.struct(F.col("b").alias("i"), F.col("a").alias("j")))
        return self.pairs.read(number).select(F.col("users").alias("c_ij"), F.inline(both)).select("i", "j", "c_ij")

    def similar_items(self, k: int = C.SIMILAR_TOP_K, number: int | None = None) -> DataFrame:
        """78 over the window as it stands."""
        return scoring.top_similar(self.counts(number), scoring.item_users(self.days.read(number)), k)
