"""Settings, backends, fan-out (52-55, 72) and serving rules (47, 68, 69)."""

from __future__ import annotations

from pyspark.sql import functions as F

from recoflow import constants as C
from recoflow.operators import candidates as cd
from recoflow.operators import settings as st
from tests.conftest import S, rows

SETTINGS = [("b0", "active", "t0", "d0", "c0", 100, 0), ("b1", "active", "t1", "d1", "c1", 99, 1),
            ("b2", "inactive", "t2", "d2", "c2", 50, 2)]
DDL = ("name string, status string, eventTrackerId string, datasetArn string, campaignArn string, "
       "trafficRatio int, backend_order int")


def active(spark):
    return spark.createDataFrame(SETTINGS, DDL).filter(F.col("status") == "active")


def test_assign_backend_weights_modulo_rule(spark):
    req = spark.range(0, 1010).withColumnRenamed("id", "request_id")
    out = st.assign_backend(req, active(spark))
    counts = dict((r.backend, r["count"]) for r in out.groupBy("backend").count().collect())
    # ratio 100 -> weight 1, ratio 99 -> weight 100; slots 0 | 1..100 of 101
    assert counts == {"b0": 10, "b1": 1000}
    assert out.filter(F.col("request_id") == 0).first().backend == "b0"


def test_assign_backend_proportional(spark):
    req = spark.range(0, 199).withColumnRenamed("id", "request_id")
    out = st.assign_backend(req, active(spark), mode="proportional")
    counts = dict((r.backend, r["count"]) for r in out.groupBy("backend").count().collect())
    assert counts == {"b0": 100, "b1": 99}


def test_fanout_has_no_join(spark):
    ev = spark.createDataFrame([("e1",), ("e2",)], "eventId string")
    out = st.fanout_events(ev, active(spark))
    assert rows(out, "eventId", "trackingId") == S([("e1", "t0"), ("e1", "t1"), ("e2", "t0"),
                                                 ("e2", "t1")])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_context_map_has_default_and_overrides(spark):
    ctx = st.context_entries(st.build_context_map(active(spark), st.filter_specs(spark)))
    got = {(r.name, r.context): (r.filter_name, r.kind) for r in ctx.collect()}
    assert got[("b0", "default")] == ("b0-unread", "unread")
    assert got[("b1", "art_same_section_mostpopular")] == ("b1-category", "category")
    assert len(got) == 6


def test_context_lookup_and_time_range_rule(spark):
    backends = st.build_context_map(active(spark), st.filter_specs(spark))
    req = spark.createDataFrame([(1, "b0", "art_same_section_mostpopular", "sports"),
                                 (2, "b0", "unknown", None), (3, "b1", "mobile_art_morestories", "x"),
                                 (4, "b1", "art_same_section_mostpopular", "drive")],
                                "request_id int, backend string, context string, category string")
    out = st.context_lookup(req, backends).select(
        "request_id", F.col("filter.kind").alias("kind"),
        st.time_range_rule(F.col("filter"), F.col("category")).alias("dated"))
    assert rows(out) == S([(1, "category", True), (2, "unread", True), (3, "exclcat", True),
                         (4, "category", False)])


def test_fallback_uses_undated_when_dated_is_empty(spark):
    cands = spark.createDataFrame(
        [(1, "a", 1.0, True), (1, "b", 0.5, False), (2, "c", 1.0, False), (2, "d", 0.5, False),
         (3, "e", 1.0, False)], "lkey int, item_id string, score double, age_ok boolean")
    keyed = spark.createDataFrame([(1, 1, True, 9), (2, 2, True, 9), (3, 3, False, 9)],
                                  "request_id int, lkey int, dated boolean, num_results int")
    out = cd.serve_lists(keyed, cd.ranked_lists(cands))
    assert rows(out, "request_id", "item_id", "backup") == S([
        (1, "a", False), (2, "c", True), (2, "d", True), (3, "e", False)])


def test_both_rankings_are_limited_before_the_shuffle(spark):
    cands = spark.range(5000).select(
        (F.col("id") % 3).alias("lkey"), F.col("id").cast("string").alias("item_id"),
        F.col("id").cast("double").alias("score"), (F.col("id") % 2 == 0).alias("age_ok"))
    out = cd.ranked_lists(cands)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 4  # per task and after the shuffle, twice
    assert {r.variant: r["count"] for r in out.groupBy("variant").count().collect()} == {
        False: 1500, True: 1500}


def test_topk_per_request_ties_by_item(spark):
    c = spark.createDataFrame([(1, "b", 0.5, 2), (1, "a", 0.5, 2), (1, "c", 0.9, 2), (2, "z", 0.1, 1)],
                              "request_id int, item_id string, score double, n int")
    out = cd.topk_per_request(c, "n")
    assert rows(out, "request_id", "item_id", "rank") == S([(1, "a", 2), (1, "c", 1), (2, "z", 1)])


def test_parse_request_tolerates_missing_sub_requests(spark):
    from recoflow.plans import recommend
    ddl = ("request_id long, visitor_id string, platform string, sub_requests array<struct<"
           "widget_id:string, limit:string, context:string, platform:string, visitor_type:string, "
           "section:string, include_sections:string, last_content_ids:string>>")
    df = spark.createDataFrame([(1, "u", None, []), (2, "u", None, None)], ddl)
    out = recommend.parse_request(df).collect()
    assert [(r.limit, r.num_results, r.context) for r in out] == [(25, 26, None), (25, 26, None)]


def test_requests_without_backend_get_empty_replies(spark):
    from recoflow import registry as R
    from recoflow.plans import recommend
    from recoflow.sources import fixtures as fx
    from tests.conftest import SMALL
    inp = recommend.Inputs(
        requests=fx.requests(spark, SMALL), interactions=R.interactions(spark, SMALL),
        items=R.items(spark, SMALL), content_meta=fx.content_meta(spark, SMALL),
        images=fx.images(spark, SMALL),
        settings=fx.settings(spark, SMALL).withColumn("status", F.lit("inactive")),
        filters=st.filter_specs(spark))
    rows, req, ranked = recommend.recommend_batch(inp, R.AS_OF)
    assert ranked.count() == 0 and rows.count() == 0
    replies = recommend.reply_assembly(rows, req).collect()
    assert len(replies) == req.count() and all('"recommendations":[]' in r.reply for r in replies)


def test_a_fourth_filter_follows_its_clauses_and_an_unknown_one_fails(spark):
    import pytest
    c = spark.createDataFrame(
        [("flagged", "a", "x", 1, 5), ("flagged", "b", "x", 0, 5), ("unread", "c", "x", 0, 0)],
        "kind string, item_id string, item_category string, item_exclude int, item_created long"
    ).withColumn("category", F.lit("x"))
    specs = [*C.FILTER_SPECS, {"name": "flagged", "clauses": ("exclude_flagged",)}]
    assert rows(c.filter(cd.kind_predicate(specs=specs)), "item_id") == S([("b",)])
    with pytest.raises(Exception, match="no filter spec named flagged"):
        c.filter(cd.kind_predicate()).collect()
    with pytest.raises(ValueError):
        cd.clauses_predicate(("include_everything",))
