"""Scalar functions (ops 13-30) on hand-written edge rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from recoflow.functions import columns as fn
from recoflow.functions import records as rec


def one(spark, ddl, data, expr):
    return [r[0] for r in spark.createDataFrame(data, ddl).select(expr.alias("x")).collect()]


def test_resolve_user_batch_prefers_user_id_even_blank(spark):
    got = one(spark, "sp_user_id string, sp_domain_userid string",
              [("u1", "d1"), (None, "d2"), ("", "d3"), (None, None)], fn.resolve_user_batch())
    assert got == ["u1", "d2", "", None]


def test_resolve_user_stream_domain_wins_blank_is_missing(spark):
    got = one(spark, "sp_user_id string, sp_domain_userid string",
              [("u1", "d1"), ("u2", None), ("u3", "  "), (" ", ""), (None, None)],
              fn.resolve_user_stream())
    assert got == ["d1", "u2", "u3", None, None]


def test_epoch_batch_iso_and_bad_text(spark):
    got = one(spark, "t string", [("2024-01-05T12:34:56.000Z",), ("garbage",), (None,)],
              fn.epoch_batch("t"))
    assert got == [1704458096, None, None]


def test_epoch_stream_falls_back_to_ingest_time(spark):
    got = one(spark, "t string", [("2024-01-05T12:34:56.000Z",), ("garbage",), ("",),
                                  ("2024-1-5T2:3:4.000Z",)],
              fn.epoch_stream("t", F.lit(42)))
    assert got == [1704458096, 42, 42, 1704420184]


def test_exclude_flag_batch_is_substring_match(spark):
    ddl = "Sponsored int, Section string, Keywords array<string>"
    data = [(0, "news", ["omitted"]), (0, "news", ["zerocanada", "x"]), (1, "news", None),
            (0, "life/horoscopes", []), (0, "news", None), (0, None, ["climate"])]
    assert one(spark, ddl, data, fn.exclude_flag_batch()) == [1, 1, 1, 1, 0, 0]


def test_exclude_flag_stream_is_exact_element_match(spark):
    ddl = "Sponsored boolean, Section string, Keywords array<string>"
    data = [(False, "news", ["omitted"]), (False, "news", ["omit"]), (True, None, None),
            (None, "life/horoscopes", None), (None, None, None)]
    assert one(spark, ddl, data, fn.exclude_flag_stream()) == [0, 1, 1, 1, 0]


def test_truncate_text_counts_characters(spark):
    got = one(spark, "t string", [("é" * 20005,), ("short",), (None,)], F.length(fn.truncate_text("t")))
    assert got == [20000, 5, None]


def test_parse_limit_and_num_results(spark):
    df = spark.createDataFrame([("5",), ("x",), (None,), ("499",), ("900",)], "l string")
    out = df.select(fn.parse_limit("l").alias("lim")).select(
        "lim", fn.num_results("lim").alias("n")).collect()
    assert [(r.lim, r.n) for r in out] == [(5, 6), (25, 26), (25, 26), (499, 500), (900, 500)]


def test_resolve_category_paths_and_aliases(spark):
    ddl = "include_sections string, section string"
    data = [("sports", "/canada/alberta"), (None, "/canada/alberta"), ("", "report-on-business"),
            (None, "/globe-investor/"), (None, None), (None, "")]
    got = one(spark, ddl, data, fn.resolve_category())
    assert got == ["sports", "canada", "business", "investing", "canada", "canada"]


def test_capitalize_like_python(spark):
    got = one(spark, "p string", [("MOBILE",), ("desktop",), ("",), (None,), ("two words",)],
              fn.capitalize("p"))
    assert got == ["Mobile", "Desktop", None, None, "Two words"]


def test_join_byline(spark):
    got = one(spark, "b array<string>", [(["A", "B"],), ([],), (None,)], fn.join_byline("b"))
    assert got == ["A and B", "", None]


def test_first_url220(spark):
    ddl = "a array<struct<url220:string>>"
    data = [([("u1",), ("u2",)],), ([],), (None,), ([(None,)],)]
    assert one(spark, ddl, data, fn.first_url220("a")) == ["u1", None, None, ""]


def test_dated_filter_name(spark):
    got = one(spark, "n string", [("grp-a-unread",)], fn.dated_filter_name("n", "2024-03-01"))
    assert got == ["grp-a-unread-2024-02-29"]


def test_event_record_omits_missing_recommendation_id(spark):
    ddl = ", ".join(f"{c} string" for c in (
        "sp_domain_sessionid", "sp_user_id", "sp_domain_userid", "sp_event_id", "sp_event_name",
        "content_contentId", "sp_derived_tstamp", "page_rid", "visitor_type",
        "visitor_countryCode", "device_detector_visitorPlatform", "device_detector_brandName",
        "device_detector_browserFamily"))
    base = ["s1", "u1", "d1", "e1", "page_view", "doc1", "2024-01-05T12:34:56.000Z"]
    data = [tuple(base + [None, "Anonymous", None, "Mobile", "Apple", "Safari"]),
            tuple(base + ["r1", "Anonymous", None, "Mobile", "Apple", "Safari"])]
    out = [r[0] for r in spark.createDataFrame(data, ddl).select(
        F.to_json(rec.event_record(F.lit(0)))).collect()]
    assert '"recommendationId"' not in out[0] and '"recommendationId":"r1"' in out[1]
    assert '\\"visitor_countryCode\\":null' in out[0]
    assert '"userId":"d1"' in out[0] and '"sentAt":1704458096' in out[0]
