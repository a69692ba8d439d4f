"""No caps on configuration, no lost rows, no growing folders."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from recoflow.functions import columns as fn
from recoflow.operators import settings as st
from recoflow.plans import monitoring
from recoflow.session import ensure_checkpoint_dir
from recoflow.sources.stream import decode_stream_events


def backends(spark, n):
    return spark.range(n).selectExpr(
        "concat('b', id) as name", "'active' as status", "concat('t', id) as eventTrackerId",
        "'d' as datasetArn", "'c' as campaignArn", "1 as trafficRatio", "cast(id as int) as backend_order")


def test_any_number_of_backends(spark):
    out = st.assign_backend(spark.range(600).withColumnRenamed("id", "request_id"), backends(spark, 300))
    assert {r.backend: r["count"] for r in out.groupBy("backend").count().collect()} == {
        f"b{i}": 2 for i in range(300)}


def test_no_active_backend_fails_the_fanout_and_leaves_the_choice_open(spark):
    none = backends(spark, 3).where("false")
    out = st.assign_backend(spark.range(2).withColumnRenamed("id", "request_id"), none)
    assert [r.backend for r in out.collect()] == [None, None]
    with pytest.raises(Exception, match="no active backend"):
        st.fanout_events(spark.createDataFrame([("e",)], "eventId string"), none).collect()


def test_alarm_of_twelve_periods_fires(spark):
    rollup = monitoring.metric_rollup(spark.range(20).select(
        (F.col("id") * 300).alias("ts"), F.lit("m").alias("metric"), F.lit(5.0).alias("value")))
    rules = monitoring.alarm_rules(spark, [("a", "m", "sum", 1.0, 12), ("b", "m", "sum", 1.0, 10)])
    fired = monitoring.alarm_rule(rollup, rules).where("in_alarm").groupBy("alarm").count()
    assert {r.alarm: r["count"] for r in fired.collect()} == {"a": 9, "b": 11}


def test_bytes_that_are_not_utf8_give_null_fields(spark):
    rows = spark.createDataFrame([("r", "//79")], "record_id string, data string")
    assert decode_stream_events(rows).first().sp_event_id is None


def test_huge_limits_are_clamped(spark):
    df = spark.createDataFrame([("2147483647",), ("99999999999",), ("-99999999999",), ("x",), ("7",)], "t string")
    out = [r.n for r in df.select(fn.num_results(fn.parse_limit("t")).alias("n")).collect()]
    assert out == [500, 500, -2147483647, 26, 8]


def test_checkpoint_path_does_not_grow(spark):
    assert len({ensure_checkpoint_dir(spark) for _ in range(100)}) == 1
