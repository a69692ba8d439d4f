"""Recommendation scoring (ops 78, 79, 80) — our own definitions.

The source system hands training and scoring to a managed service and
only names the recipes, so the formulas here are ours, chosen to be
stated in SQL:

* 78 similar items: ``V`` = distinct (user, item) views; ``n_i`` = users of
  item i; ``c_ij`` = users of both (i != j);
  ``sim = c_ij / sqrt(n_i * n_j)``; top ``k`` per item by (sim desc, j asc).
* 79 personalisation: ``w(u,i) = 0.5 ^ ((as_of - last_view(u,i)) / 1 day)``;
  ``aff(u,j) = sum_i w(u,i) * sim(i,j)`` divided by the user's maximum;
  ``fresh(j) = 1`` when the item is at most one day old;
  ``score = 0.7 * aff + 0.3 * fresh``.  Candidates are the items reachable
  through similarity (aff > 0).  Users without history are served from
  popularity (see ``segment_popularity``).
* 80 ranking: a given candidate list ordered by the 79 score (missing = 0).

Scale notes.  The co-view count is a self-join on user.  One heavy user
(a crawler, a shared device id) can hold a large share of all views, and
a plain self-join would build all of that user's pairs in one task.  Users
are therefore split into item blocks of at most ``block_items`` items;
block pairs become separate join keys, so no task handles more than
``block_items**2`` pairs of one user, and the pair counts are combined
map-side (partial aggregation) before the shuffle on (i, j).  No user's
history is cut: the result is exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recoflow import constants as C
from recoflow.functions.columns import midnight_epoch
from recoflow.session import materialize

DEFAULT_BLOCK_ITEMS = 2048


def distinct_views(interactions: DataFrame, user: str = "USER_ID",
                   item: str = "ITEM_ID") -> DataFrame:
    return interactions.select(F.col(user).alias("u"), F.col(item).alias("i")).distinct()


def item_users(views: DataFrame) -> DataFrame:
    """n_i: distinct users per item."""
    return views.groupBy("i").agg(F.count(F.lit(1)).alias("n_i"))


def co_view_counts(views: DataFrame, block_items: int = DEFAULT_BLOCK_ITEMS) -> DataFrame:
    """(i, j, c_ij) for i != j, exact, skew-safe (block-split heavy users)."""
    deg = views.groupBy("u").agg(F.count(F.lit(1)).alias("d"))
    nb = F.greatest(F.lit(1), F.ceil(F.col("d") / F.lit(block_items)).cast("int"))
    v = (views.join(deg, "u")
         .withColumn("nb", nb)
         .withColumn("b", F.pmod(F.xxhash64("i"), F.col("nb").cast("long")).cast("int")))
    # each unordered pair once: left copies for the blocks from its own on,
    # right copies for the blocks up to its own; mirrored after the count
    left = v.select("u", "i", F.col("b").alias("bl"),
                    F.explode(F.sequence(F.col("b"), F.col("nb") - 1)).alias("br"))
    right = v.select("u", F.col("i").alias("j"), F.col("b").alias("br"),
                     F.explode(F.sequence(F.lit(0), F.col("b"))).alias("bl"))
    pairs = left.join(right, ["u", "bl", "br"]).filter(
        (F.col("bl") < F.col("br")) | (F.col("i") < F.col("j")))
    counts = (pairs.groupBy(F.least("i", "j").alias("a"), F.greatest("i", "j").alias("b"))
              .agg(F.count(F.lit(1)).alias("c_ij")))
    both = F.array(F.struct(F.col("a").alias("i"), F.col("b").alias("j")),
                   F.struct(F.col("b").alias("i"), F.col("a").alias("j")))
    return counts.select("c_ij", F.inline(both)).select("i", "j", "c_ij")


def similar_items(interactions: DataFrame, k: int = C.SIMILAR_TOP_K,
                  block_items: int = DEFAULT_BLOCK_ITEMS) -> DataFrame:
    """78: top-k co-viewed items per item with cosine similarity.

    Output: ``item_id, similar_item_id, sim, rank``.
    """
    views = distinct_views(interactions)
    return top_similar(co_view_counts(views, block_items), item_users(views), k)


def top_similar(c: DataFrame, n: DataFrame, k: int = C.SIMILAR_TOP_K) -> DataFrame:
    """78 from counts: ``c`` (i, j, c_ij) for i != j, ``n`` (i, n_i)."""
    scored = (c.join(n, "i")
              .join(n.select(F.col("i").alias("j"), F.col("n_i").alias("n_j")), "j")
              .select("i", "j", (F.col("c_ij").cast("double")
                                 / F.sqrt(F.col("n_i").cast("double") * F.col("n_j").cast("double")))
                      .alias("sim")))
    w = Window.partitionBy("i").orderBy(F.col("sim").desc(), F.col("j").asc())
    # row_number + filter lets Spark keep only k rows per item before the
    # window's shuffle (WindowGroupLimit)
    top = scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return top.select(F.col("i").alias("item_id"), F.col("j").alias("similar_item_id"),
                      "sim", "rank")


def view_history(interactions: DataFrame) -> DataFrame:
    """(u, i, last_view): latest view per user and item (partial aggregation)."""
    return (interactions.groupBy(F.col("USER_ID").alias("u"), F.col("ITEM_ID").alias("i"))
            .agg(F.max("TIMESTAMP").alias("last_view")))


def recency_weight(last_view, as_of, half_life: int = C.RECENCY_HALF_LIFE_SECONDS):
    """0.5 ** ((as_of - last_view) / half_life); ``last_view`` in epoch seconds."""
    lv = F.col(last_view) if isinstance(last_view, str) else last_view
    age = midnight_epoch(as_of, 0) - lv
    return F.pow(F.lit(0.5), age.cast("double") / F.lit(float(half_life)))


def freshness(items: DataFrame, as_of, max_age: int = C.FRESH_AGE_SECONDS) -> DataFrame:
    """(item_id, fresh): 1 when created at most ``max_age`` seconds before as_of."""
    age = midnight_epoch(as_of, 0) - F.col("CREATION_TIMESTAMP")
    return items.select(F.col("ITEM_ID").alias("item_id"),
                        F.when(F.coalesce(age <= max_age, F.lit(False)), 1).otherwise(0)
                        .alias("fresh"))


def user_personalization(interactions: DataFrame, items: DataFrame, as_of,
                         sims: DataFrame | None = None, k: int = C.SIMILAR_TOP_K,
                         users: DataFrame | None = None) -> DataFrame:
    """79: (user_id, item_id, affinity, fresh, score) for every reachable item.

    ``users`` (one column ``u``): score these only; similarities are still
    those of all interactions.

    history (u, i, w) joins the top-k similarity lists on i (each history
    row fans out to at most k rows), then a partial aggregation sums per
    (u, j).  The per-user maximum is a second aggregation joined back on
    ``u`` (a shuffle join AQE can split when one user is huge) rather than
    a window that would hold a user's whole candidate list in one task.
    """
    if sims is None:
        sims = similar_items(interactions, k)
    hist = view_history(interactions).withColumn(
        "w", recency_weight("last_view", as_of)).select("u", "i", "w")
    if users is not None:
        hist = hist.join(users, "u", "left_semi")
    s = sims.select(F.col("item_id").alias("i"), F.col("similar_item_id").alias("j"), "sim")
    # read twice: by the maximum per user and by the join with it
    aff = materialize(hist.join(s, "i").groupBy("u", "j")
                      .agg(F.sum(F.col("w") * F.col("sim")).alias("raw")))
    top = aff.groupBy("u").agg(F.max("raw").alias("mx"))
    fresh = freshness(items, as_of)
    out = (aff.join(top, "u")
           .select(F.col("u").alias("user_id"), F.col("j").alias("item_id"),
                   (F.col("raw") / F.col("mx")).alias("affinity"))
           .join(fresh, "item_id", "left")
           .withColumn("fresh", F.coalesce("fresh", F.lit(0)))
           .withColumn("score", F.lit(C.AFFINITY_WEIGHT) * F.col("affinity")
                       + F.lit(C.FRESHNESS_WEIGHT) * F.col("fresh")))
    return out.select("user_id", "item_id", "affinity", "fresh", "score")


def segment_popularity(interactions: DataFrame) -> DataFrame:
    """Cold-start popularity per (platform, visitor_type) segment.

    One pass with ``GROUPING SETS``: the full segment, each field alone and
    the overall total.  ``seg_level`` (``grouping_id``) tells a rolled-up
    "any" apart from a real NULL value.  Popularity = distinct users per
    item, normalised by the segment's maximum.
    """
    views = interactions.select(
        F.col("device_detector_visitorplatform").alias("platform"),
        F.col("visitor_type"), F.col("ITEM_ID").alias("item_id"), F.col("USER_ID"))
    keys = ["platform", "visitor_type", "item_id"]
    sets = [keys, ["platform", "item_id"], ["visitor_type", "item_id"], ["item_id"]]
    cnt = (views.groupingSets(sets, *keys)
           .agg(F.countDistinct("USER_ID").alias("users"), F.grouping_id().alias("gid"))
           .withColumn("seg_level", (F.col("gid") / 2).cast("int"))
           .drop("gid"))
    seg = ["platform", "visitor_type", "seg_level"]
    # per-segment maximum: an aggregate joined back (segments are few), not a
    # window that would put a whole segment's items in one task
    mx = cnt.groupBy(*seg).agg(F.max("users").alias("mx")).alias("m")
    c = cnt.alias("c")
    return (c.join(mx, [F.col(f"c.{k}").eqNullSafe(F.col(f"m.{k}")) for k in seg])
            .select(*[F.col(f"c.{k}").alias(k) for k in seg], "item_id", "users",
                    (F.col("users") / F.col("mx")).alias("popularity")))


def personalized_ranking(candidates: DataFrame, scores: DataFrame,
                         key: str = "request_id") -> DataFrame:
    """80: order a given (key, user_id, item_id) candidate list by score.

    Missing scores count as 0; ties by item id.  Candidate lists are per
    request and bounded by the caller.
    """
    s = scores.select("user_id", "item_id", "score")
    joined = (candidates.join(s, ["user_id", "item_id"], "left")
              .withColumn("score", F.coalesce("score", F.lit(0.0))))
    w = Window.partitionBy(key).orderBy(F.col("score").desc(), F.col("item_id").asc())
    return joined.withColumn("rank", F.row_number().over(w))
