"""Filters (31-40, 46, 48), validation (10, 41, 42) and their NULL rules."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from recoflow import constants as C
from recoflow import schemas
from recoflow.operators import filters as flt
from recoflow.operators.validate import split, validate_content, validate_dataset, validate_events
from tests.conftest import S, rows


def test_denylists_keep_null(spark):
    df = spark.createDataFrame([("Googlebot", "localhost"), (None, None), ("Bell", "www.x.com")],
                               "sp_ip_isp string, sp_page_urlhost string")
    assert rows(flt.isp_denylist(df), "sp_ip_isp") == S([(None,), ("Bell",)])
    assert rows(flt.host_denylist(df), "sp_page_urlhost") == S([(None,), ("www.x.com",)])


def test_host_denylist_table_form_matches_literal_form(spark):
    df = spark.createDataFrame([("localhost",), (None,), ("a.com",)], "sp_page_urlhost string")
    hosts = spark.createDataFrame([("localhost",)], "host string")
    assert rows(flt.host_denylist_table(df, hosts)) == rows(flt.host_denylist(df))


def test_bot_and_premium_keep_null(spark):
    df = spark.createDataFrame([("Bot", "PREMIUM~PREMIUM~~~~~x"), (None, None), ("Mobile", "BASIC")],
                               "device_detector_visitorplatform string, visitor_servicecode string")
    assert len(flt.bot_filter(df).collect()) == 2
    assert len(flt.premium_filter(df).collect()) == 2


def test_recent_windows_are_strict(spark):
    # midnight 2024-01-24 UTC = 1706054400
    df = spark.createDataFrame([(1706054400,), (1706054401,), (None,)], "TIMESTAMP long")
    assert rows(flt.recent_interactions(df, "2024-01-31")) == S([(1706054401,)])


def test_item_age_keeps_null_creation(spark):
    # midnight 2024-01-28 UTC = 1706400000
    df = spark.createDataFrame([(1706399999,), (1706400000,), (None,)], "CREATION_TIMESTAMP long")
    assert rows(flt.item_filter_age(df, "2024-01-31")) == S([(None,), (1706400000,)])


def test_drop_last_content(spark):
    df = spark.createDataFrame([("a", "a"), ("b", "a"), ("c", None), ("d", "")],
                               "content_id string, last_content_ids string")
    assert rows(flt.drop_last_content(df), "content_id") == S([("b",), ("c",), ("d",)])


EVENT_COLS = ["sp_event_id", "sp_derived_tstamp", "sp_app_id", "content_contentId", "page_type",
              "device_detector_visitorPlatform", "sp_page_urlhost", "sp_event_name",
              "sp_domain_sessionid", "sp_user_id", "sp_domain_userid"]
GOOD = ["e", "2024-01-05T12:34:56.000Z", C.APP_ID, "doc1", "article", "Mobile",
        "www.x.com", "page_view", "s", "u", "d"]


def _event(**over):
    r = dict(zip(EVENT_COLS, GOOD))
    r.update(over)
    return tuple(r[c] for c in EVENT_COLS)


def test_validate_events_first_failure_wins(spark):
    data = [_event(), _event(sp_event_id=None, page_type="x"), _event(sp_derived_tstamp=" "),
            _event(content_contentId=""), _event(device_detector_visitorPlatform="Bot"),
            _event(sp_page_urlhost="localhost"), _event(sp_user_id=" ", sp_domain_userid=None),
            _event(sp_domain_userid=None), _event(device_detector_visitorPlatform=None,
                                                  sp_page_urlhost=None)]
    df = spark.createDataFrame(data, ", ".join(f"{c} string" for c in EVENT_COLS))
    got = [r.skip_reason for r in validate_events(df).collect()]
    assert got == [None, "NO_EVENT_ID", "NO_TIME",
                   "NO_ITEM", "BOT",
                   "DENIED_HOST", "NO_USER", None, None]


def test_validate_content(spark):
    ddl = "ContentId string, Category string, Published boolean, ContentText string"
    data = [("a", "c", True, "t"), (None, "c", True, "t"), ("a", "c", None, "t"),
            ("a", "c", False, "t"), ("a", "c", True, None)]
    got = [r.skip_reason for r in validate_content(spark.createDataFrame(data, ddl)).collect()]
    assert got == [None, "NO_ID_OR_CATEGORY", "NOT_PUBLISHED",
                   "NOT_PUBLISHED", "NO_TEXT"]


def test_validate_dataset_casts_and_rejects(spark):
    df = spark.createDataFrame([("i1", 5, "t", "c", 3000000000, 0), (None, 5, "t", "c", 1, 0),
                                ("i3", None, None, None, None, None)],
                               "ITEM_ID string, CREATION_TIMESTAMP long, ContentText string, "
                               "Category string, WordCount long, Exclude int")
    out = validate_dataset(df, schemas.ITEMS_FIELDS).collect()
    assert [r.skip_reason for r in out] == ["bad WordCount", "missing ITEM_ID",
                                           "missing CREATION_TIMESTAMP"]
    assert dict(validate_dataset(df, schemas.ITEMS_FIELDS).dtypes)["WordCount"] == "int"


def test_avro_fields_parse():
    js = {"fields": [{"name": "A", "type": "string"}, {"name": "B", "type": ["int", "null"]}]}
    assert schemas.avro_fields(js) == (("A", "string", False), ("B", "int", True))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.sampled_from([None, "", " ", "x", "Bot", "localhost", "page_view", "article"]),
                min_size=len(EVENT_COLS), max_size=len(EVENT_COLS)))
def test_validation_partitions_input(spark, vals):
    """Property: valid + skipped = input, and filters never add rows."""
    df = spark.createDataFrame([tuple(vals), _event()], ", ".join(f"{c} string" for c in EVENT_COLS))
    valid, skipped = split(validate_events(df))
    assert valid.count() + skipped.count() == 2
    f = flt.host_denylist(df.withColumnRenamed("sp_page_urlhost", "sp_page_urlhost"))
    assert f.count() <= 2
    assert flt.bot_filter(df.withColumnRenamed("device_detector_visitorPlatform",
                                               "device_detector_visitorplatform")).count() <= 2
    assert df.filter(F.lit(True)).count() == 2
