"""Connected components of a link table by large-star and small-star rounds.

Every round hangs neighbours on the smallest node they see; the number of
rounds grows with the logarithm of the longest chain. Each round is
written to the shared folder; no links are collected anywhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize


def _to_smallest(pairs: DataFrame, keep: str) -> DataFrame:
    """Links (b, m) of the neighbours b of each a to the smallest m seen by a."""
    least = pairs.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return pairs.join(least, "a").where(keep).select(F.col("b").alias("a"), F.col("m").alias("b"))


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in ``links`` (a, b: long, not null);
    the component is its smallest node. Loops and repeated links do no harm."""
    both = links.where("a != b")
    edges = materialize(both.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    sign = None
    while True:
        # large star: neighbours larger than a go to the smallest around a
        mirrored = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _to_smallest(mirrored, "b > a").where("a != b").distinct()
        # small star: a and its smaller neighbours go to the smallest of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        after = materialize(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "links")
        discard(edges)
        edges = after
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == sign:
            break
        sign = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component"))).groupBy("node").agg(F.min("component").alias("component"))
