"""Batch recommendation serving (ops 23-28, 47-50, 58, 65, 81).

The request handler of the source system answers one HTTP request at a
time with remote calls.  Here a table of requests is answered in one
job: every step is a column expression or a join, and the only
per-request state is each request's bounded candidate list.

Chain (op 81): 23 parse -> 55 backend -> 54 context -> 24 category ->
25 user context -> 47 time-range rule -> 79 scores (warm users) or
segment popularity (cold users) -> 43-46 filters -> 69 fallback ->
68 top-k -> 49 metadata -> 50 images -> 26-28 reply fields ->
48 drop current article -> cut to limit -> 65 reply JSON, 58 coverage.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recoflow import constants as C
from recoflow.functions import columns as fn
from recoflow.operators import candidates as cd
from recoflow.operators import scoring
from recoflow.operators import settings as st
from recoflow.operators.filters import drop_last_content
from recoflow.operators.projections import json_number, rename_fields
from recoflow.session import materialize
from recoflow.sources.readers import scan_active_settings


def parse_request(requests: DataFrame) -> DataFrame:
    """23: first sub-request; limit as int (default 25); ask limit + 1, cap 500."""
    sub = F.get(F.col("sub_requests"), 0)
    limit = fn.parse_limit(sub["limit"])
    return requests.select(
        "request_id", "visitor_id",
        sub["widget_id"].alias("widget_id"),
        limit.alias("limit"),
        fn.num_results(limit).alias("num_results"),
        sub["context"].alias("context"),
        sub["platform"].alias("platform"),
        sub["visitor_type"].alias("visitor_type"),
        sub["section"].alias("section"),
        sub["include_sections"].alias("include_sections"),
        sub["last_content_ids"].alias("last_content_ids"),
    )


def resolve_request(requests: DataFrame, settings: DataFrame, filters: DataFrame,
                    as_of) -> DataFrame:
    """23 -> 55 -> 54 -> 24 -> 25 -> 47: everything decided per request."""
    active = scan_active_settings(settings)
    backends = st.build_context_map(active, filters)
    req = st.assign_backend(parse_request(requests), active)
    req = st.context_lookup(req, backends)
    f = F.col("filter")
    category = F.when(st.uses_category(f), fn.resolve_category())
    return (req.withColumn("category", category)
            .withColumn("kind", f["kind"])
            .withColumn("filter_name", f["filter_name"])
            .withColumn("dated", st.time_range_rule(f, F.col("category")))
            .withColumn("dated_filter_name", fn.dated_filter_name(f["filter_name"], as_of))
            .withColumn("ctx_platform", fn.capitalize("platform"))
            .withColumn("ctx_visitor_type", fn.capitalize("visitor_type"))
            .drop("filter"))


@dataclass
class Inputs:
    requests: DataFrame
    interactions: DataFrame
    items: DataFrame
    content_meta: DataFrame
    images: DataFrame
    settings: DataFrame
    filters: DataFrame


# A ranked list is shared by every request with the same list key: the
# visitor (warm) or the popularity segment (cold), plus the filter kind and
# category.  Requests only differ in how long a prefix they take and in
# whether the dated variant applies.
KEY_FIELDS = (("user_id", "string"), ("platform", "string"), ("visitor_type", "string"),
              ("seg_level", "int"), ("kind", "string"), ("category", "string"))


def list_key(**cols) -> F.Column:
    return F.struct(*[(cols[n] if n in cols else F.lit(None)).cast(t).alias(n)
                      for n, t in KEY_FIELDS])


def warm_candidates(req: DataFrame, interactions: DataFrame, items: DataFrame, as_of,
                    k: int = C.SIMILAR_TOP_K) -> tuple[DataFrame, DataFrame]:
    """Visitors with history: (candidate rows per list key, request -> key).

    Scores (op 79) are joined once per distinct (visitor, kind, category),
    not once per request, then filtered (43-46, 51).
    """
    visitors = req.select(F.col("visitor_id").alias("u")).distinct()
    scores = scoring.user_personalization(interactions, items, as_of, k=k, users=visitors)
    keyed = req.select("request_id", F.col("visitor_id").alias("user_id"), "kind", "category")
    keys = keyed.select("user_id", "kind", "category").distinct()
    c = keys.join(scores.select("user_id", "item_id", "score"), "user_id")
    c = cd.with_item_attributes(c, items).filter(cd.kind_predicate())
    c = cd.exclude_viewed(c, interactions)
    key = list_key(user_id=F.col("user_id"), kind=F.col("kind"), category=F.col("category"))
    return (c.select(key.alias("lkey"), "item_id", "score", cd.passes_age(as_of).alias("age_ok")),
            keyed.select("request_id", key.alias("lkey")))


def cold_candidates(req: DataFrame, interactions: DataFrame, items: DataFrame,
                    as_of) -> tuple[DataFrame, DataFrame]:
    """Visitors without history: popularity lists per (segment, kind, category).

    A request's segment is (platform, visitor_type) as far as the request
    gives them; a segment never seen in the interactions falls back to the
    overall popularity.  Cold visitors have no views to exclude.

    A category list meets the items of its category only.  An exclusion of
    a category that no item has excludes nothing, so it shares the list
    without category: there are as many lists as segments and categories
    of the catalogue, whatever text requests give.
    """
    pop = scoring.segment_popularity(interactions)
    p, v = F.col("ctx_platform"), F.col("ctx_visitor_type")
    level = (F.when(p.isNotNull() & v.isNotNull(), 0).when(p.isNotNull(), 1)
             .when(v.isNotNull(), 2).otherwise(3))
    seg = req.select("request_id", "kind", "category",
                     F.when(level.isin(0, 1), p).alias("platform"),
                     F.when(level.isin(0, 2), v).alias("visitor_type"),
                     level.alias("seg_level"))
    segkey = ["platform", "visitor_type", "seg_level"]
    known = pop.select(*segkey).distinct().withColumn("__known", F.lit(True)).alias("k")
    has = seg.alias("s").join(known, _nullsafe("s", "k", segkey), "left").select(
        "s.*", "__known")
    seg = (has.withColumn("platform", F.when(F.col("__known"), F.col("platform")))
              .withColumn("visitor_type", F.when(F.col("__known"), F.col("visitor_type")))
              .withColumn("seg_level", F.when(F.col("__known"), F.col("seg_level")).otherwise(3))
              .drop("__known"))
    used = items.select(F.col("Category").alias("category"), F.lit(True).alias("__used")).distinct()
    stray = (F.col("kind").isin(cd.kinds_with("exclude_category"))
             & ~F.col("kind").isin(cd.kinds_with("include_category")) & F.col("__used").isNull())
    seg = (seg.join(used, "category", "left")
           .withColumn("category", F.when(~stray, F.col("category"))).drop("__used"))
    combo_cols = segkey + ["kind", "category"]
    combos = seg.select(*combo_cols).distinct()
    fresh = scoring.freshness(items, as_of)
    scored = (pop.join(fresh, "item_id", "left")
              .withColumn("score", F.lit(C.AFFINITY_WEIGHT) * F.col("popularity")
                          + F.lit(C.FRESHNESS_WEIGHT) * F.coalesce("fresh", F.lit(0))))
    scored = cd.with_item_attributes(scored, items).alias("p")
    by_category = F.coalesce(F.col("kind").isin(cd.kinds_with("include_category")), F.lit(False))
    same = _nullsafe("cb", "p", segkey)
    lists = [combos.filter(by_category).alias("cb").join(
                 scored, [*same, F.col("cb.category") == F.col("p.item_category")])]
    # a category left out: the segment's best rows of every other category
    best = cd.best_by_category(scored.drop("kind", "category"), segkey, as_of).alias("p")
    lists.append(combos.filter(~by_category).filter(cd.known_kind()).alias("cb").join(
        best, [*same, F.col("cb.kind") == F.col("p.kind")]))
    attributes = ["item_id", "score", "item_category", "item_exclude", "item_created"]
    one, other = (x.select(*[F.col(f"cb.{c}").alias(c) for c in combo_cols], *attributes)
                  for x in lists)
    per = one.unionByName(other).filter(cd.kind_predicate())
    key = list_key(**{c: F.col(c) for c in combo_cols})
    return (per.select(key.alias("lkey"), "item_id", "score", cd.passes_age(as_of).alias("age_ok")),
            seg.select("request_id", key.alias("lkey")))


def _nullsafe(a: str, b: str, cols) -> list:
    return [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in cols]


INTERACTION_COLUMNS = ("USER_ID", "ITEM_ID", "TIMESTAMP", "EVENT_TYPE", "visitor_type",
                       "device_detector_visitorplatform")
ITEM_COLUMNS = ("ITEM_ID", "CREATION_TIMESTAMP", "Category", "Exclude")


def recommend_candidates(inp: Inputs, as_of) -> tuple[DataFrame, DataFrame]:
    """(resolved requests, ranked top num_results rows per request).

    The interactions and items feed six and four branches of the plan;
    both are pruned to the columns used and materialised once, as are the
    resolved requests (read by five branches).  Candidate
    lists are built per list key and shared by the requests that use them.
    """
    inter = materialize(inp.interactions.select(*INTERACTION_COLUMNS))
    items = materialize(inp.items.select(*ITEM_COLUMNS))
    req = materialize(resolve_request(inp.requests, inp.settings, inp.filters, as_of))
    # no active backend: the request is answered with an empty reply
    served = req.filter(F.col("backend").isNotNull())
    users = inter.select(F.col("USER_ID").alias("visitor_id")).distinct()
    warm_c, warm_k = warm_candidates(served.join(users, "visitor_id", "left_semi"), inter, items,
                                     as_of)
    cold_c, cold_k = cold_candidates(served.join(users, "visitor_id", "left_anti"), inter, items,
                                     as_of)
    # both rankings and the counts read the candidates
    lists = cd.ranked_lists(materialize(warm_c.unionByName(cold_c)))
    keyed = warm_k.unionByName(cold_k).join(
        req.select("request_id", "dated", "num_results"), "request_id")
    return req, cd.serve_lists(keyed, lists)


def metadata_fields(meta: DataFrame) -> DataFrame:
    """26 + 27: lower-case + rename metadata attributes, byline as text."""
    r = rename_fields(meta.drop("doc_id") if "doc_id" in meta.columns else meta)
    return r.withColumn("byline", fn.join_byline("byline"))


def image_fields(images: DataFrame) -> DataFrame:
    """28: first url220 of the author and picture lists."""
    return images.select(
        F.col("ContentID").alias("content_id"),
        fn.first_url220("AuthorRel").alias("author_url220"),
        fn.first_url220("PictureRel").alias("picture_url220"),
        F.lit(True).alias("has_images"))


def enrich_metadata(rows: DataFrame, content_meta: DataFrame, item: str = "item_id") -> DataFrame:
    """49: inner join with the articles' metadata, named as in the reply (``content_id`` is the item)."""
    return rows.join(metadata_fields(content_meta), F.col(item) == F.col("content_id"))


def enrich_images(rows: DataFrame, images: DataFrame, item: str = "item_id") -> DataFrame:
    """50: left join with the images' urls; ``has_images`` is null for an article without a row."""
    urls = image_fields(images).withColumnRenamed("content_id", "__image_of")
    return rows.join(urls, F.col(item) == F.col("__image_of"), "left").drop("__image_of")


def recommend_batch(inp: Inputs, as_of) -> tuple[DataFrame, DataFrame, DataFrame]:
    """81: (reply rows, resolved requests, ranked candidates).

    Reply rows: one per (request, position) with the renamed metadata
    fields and image urls, current article removed, cut to the limit.
    """
    req, ranked = recommend_candidates(inp, as_of)
    ranked = materialize(ranked)  # the reply rows and the coverage read it
    rows = ranked.select("request_id", "item_id", "rank", "score", "backup", "num_results")
    rows = enrich_images(enrich_metadata(rows, inp.content_meta), inp.images)
    rows = rows.join(req.select("request_id", "last_content_ids"), "request_id")
    rows = drop_last_content(rows, "content_id", "last_content_ids")
    w = F.row_number().over(Window.partitionBy("request_id").orderBy("rank"))
    rows = rows.withColumn("position", w).filter(F.col("position") <= F.col("num_results") - 1)
    return rows, req, ranked


#: The metadata attributes of an article, named as in the reply.
REPLY_FIELDS = tuple(C.REPLY_RENAMES.get(a.lower(), a.lower()) for a in C.METADATA_ATTRIBUTES)


def reply_assembly(rows: DataFrame, req: DataFrame) -> DataFrame:
    """65: one JSON reply per request, recommendations in rank order.

    Rows of a request are bounded (at most 499), so ``collect_list`` per
    request is bounded; requests with no rows get an empty list.
    """
    rec = F.struct(
        F.col("position"),
        *[F.col(c) for c in REPLY_FIELDS],
        F.when(F.col("has_images"), F.array(F.struct(F.col("author_url220").alias("url220"))))
        .alias("author_rel"),
        F.when(F.col("has_images"), F.array(F.struct(F.col("picture_url220").alias("url220"))))
        .alias("picture_rel"),
        F.when(F.col("has_images"), F.struct(F.struct(F.col("picture_url220").alias("url220"))
                                             .alias("urls"))).alias("promo_image"),
    )
    per = rows.groupBy("request_id").agg(F.array_sort(F.collect_list(rec)).alias("recs"))
    base = req.select("request_id", "widget_id", "backend")
    j = base.join(per, "request_id", "left")
    recs = F.coalesce(F.col("recs"), F.array().cast(per.schema["recs"].dataType))
    # the id later page views carry back as page_rid (counted by op 63)
    rid = F.when(F.col("backend").isNotNull(),
                 F.concat(F.col("backend"), F.lit(":"), F.col("request_id").cast("string")))
    reply = F.struct(F.col("request_id"), F.lit(0).alias("container_position"),
                     F.col("widget_id"), rid.alias("recommendationId"),
                     F.transform(recs, lambda r: r.dropFields("position").withField(
                         "word_count", json_number(r["word_count"])))
                     .alias("recommendations"))
    return j.select("request_id", F.to_json(reply, {"ignoreNullFields": "false"}).alias("reply"))


def coverage_metrics(rows: DataFrame, req: DataFrame, ranked: DataFrame,
                     content_meta: DataFrame, images: DataFrame) -> DataFrame:
    """58: per request: returned, missing, missing metadata, missing images,
    and the number of items that came from the fallback (backup)."""
    has_meta = content_meta.select(F.col("ContentId").alias("item_id"), F.lit(1).alias("m")).distinct()
    has_image = images.select(F.col("ContentID").alias("item_id"), F.lit(1).alias("i")).distinct()
    got = (ranked.select("request_id", "item_id", "backup")
           .join(has_meta, "item_id", "left").join(has_image, "item_id", "left")
           .groupBy("request_id").agg(
               F.count(F.lit(1)).alias("returned"), F.count("m").alias("n_meta"),
               F.count("i").alias("n_img"), F.count_if(F.col("backup")).alias("backup")))
    out = req.select("request_id", "num_results").join(got, "request_id", "left")
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    return out.select(
        "request_id",
        z("returned").cast("long").alias("returned"),
        (F.col("num_results") - z("returned")).cast("long").alias("missing"),
        (F.col("num_results") - z("n_meta")).cast("long").alias("missing_metadata"),
        (F.col("num_results") - z("n_img")).cast("long").alias("missing_images"),
        z("backup").cast("long").alias("backup"))
