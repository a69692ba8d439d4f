"""ETL jobs, sources and sinks (1-5, 11, 12, 56, 66, 67, 82, 83)."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import functions as F

from recoflow import schemas
from recoflow.operators import projections as pj
from recoflow.plans import etl
from recoflow.sources import fixtures as fx
from recoflow.sources import readers, writers
from tests.conftest import SMALL, S, rows


def test_rolling_month_prunes_partitions(spark):
    """On a partitioned store the date predicate is a partition filter."""
    path = tempfile.mkdtemp(prefix="raw-events-") + "/raw"
    fx.raw_events(spark, SMALL).write.partitionBy("year", "month", "day").parquet(path)
    df = readers.read_raw_events(spark, path, "2024-01-10")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*year#", plan)
    days = {r.day for r in df.select("day").distinct().collect()}
    assert days == set(range(1, 11))


def test_rolling_month_january_reads_december(spark):
    df = spark.createDataFrame([(2023, 12, 15), (2023, 12, 16), (2024, 1, 15), (2024, 1, 16)],
                               "year int, month int, day int")
    assert rows(readers.scan_rolling_month(df, "2024-01-15")) == S([(2023, 12, 16), (2024, 1, 15)])


def test_pivot_discovers_keys_and_fixed_keys_agree(spark):
    raw = fx.raw_events(spark, SMALL)
    a = pj.pivot_attributes(raw)
    b = pj.pivot_attributes(raw, fx.BATCH_ATTRIBUTE_KEYS)
    assert sorted(a.columns) == sorted(b.columns)
    assert a.select(sorted(a.columns)).exceptAll(b.select(sorted(a.columns))).count() == 0


def test_build_interactions_columns_order_and_filters(spark):
    out = etl.build_interactions(fx.raw_events(spark, SMALL), fx.AS_OF,
                                 keys=fx.BATCH_ATTRIBUTE_KEYS)
    assert tuple(out.columns) == etl.INTERACTION_COLUMNS
    got = [(r.USER_ID, r.TIMESTAMP) for r in out.collect()]
    assert got == sorted(got)
    assert out.filter(F.col("ITEM_ID").contains("http")).count() == 0
    assert out.filter(F.col("TIMESTAMP") <= 1706054400).count() == 0


def test_build_items_reads_only_what_it_needs(spark):
    items = etl.build_items(fx.raw_items(spark, SMALL), fx.AS_OF)
    assert tuple(items.columns) == etl.ITEM_COLUMNS
    assert dict(items.dtypes)["Exclude"] == "int"
    plan = items.select("ITEM_ID", "Category")._jdf.queryExecution().executedPlan().toString()
    read = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert "lang" not in read and "source" not in read and "n_chars" not in read


def test_csv_round_trip_keeps_text_newlines_quotes_and_empty(spark):
    df = spark.createDataFrame([("a", 'line1\nsaid "hi", ok', ""), ("b", None, None)],
                               "ITEM_ID string, ContentText string, Category string")
    path = writers.write_csv(df, tempfile.mkdtemp(prefix="csv-") + "/out")
    back = writers.read_csv(spark, path, df.schema)
    assert rows(back) == rows(df)


def test_refresh_snapshot_pointer_switch(spark):
    dest = tempfile.mkdtemp(prefix="snap-")
    a = spark.createDataFrame([("x",)], "ITEM_ID string")
    writers.refresh_snapshot(spark, {"items": a}, dest, version="v1")
    b = spark.createDataFrame([("y",), ("z",)], "ITEM_ID string")
    writers.refresh_snapshot(spark, {"items": b}, dest, version="v2")
    cur = writers.current_snapshot(spark, dest, "items", a.schema)
    assert rows(cur) == S([("y",), ("z",)])


def test_distinct_attribute_keys(spark):
    keys = {r.key for r in pj.distinct_attribute_keys(fx.raw_events(spark, SMALL)).collect()}
    assert keys == set(fx.BATCH_ATTRIBUTE_KEYS)


def test_apply_mapping_and_decimal_to_number(spark):
    m = pj.apply_mapping(fx.raw_items(spark, SMALL))
    assert dict(m.dtypes)["Sponsored"] == "int"
    d = pj.decimal_to_number(spark.sql("SELECT CAST(1.5 AS DECIMAL(10,2)) a, CAST(2 AS DECIMAL(10,0)) b"))
    assert d.select(F.to_json("a"), F.to_json("b")).first() == ("1.5", "2")
    whole = pj.decimal_to_number(spark.sql("SELECT CAST(120 AS DECIMAL(10,2)) a, CAST(NULL AS DECIMAL(10,2)) b"))
    assert whole.select(F.to_json("a"), "b").first() == ("120", None)


def test_interactions_schema_is_importable(spark):
    assert [f.name for f in schemas.interactions_csv_schema().fields] == list(etl.INTERACTION_COLUMNS)


def test_flat_store_pushes_rule_predicates_and_matches(spark):
    """A store flattened by promote_attributes gives the same interactions,
    and the rule predicates reach the Parquet scan."""
    raw_path = tempfile.mkdtemp(prefix="raw-map-") + "/raw"
    fx.raw_events(spark, SMALL).write.partitionBy("year", "month", "day").parquet(raw_path)
    flat_path = etl.promote_attributes(spark.read.parquet(raw_path),
                                       tempfile.mkdtemp(prefix="raw-flat-") + "/flat",
                                       fx.BATCH_ATTRIBUTE_KEYS)
    a = etl.build_interactions(spark.read.parquet(raw_path), fx.AS_OF, keys=fx.BATCH_ATTRIBUTE_KEYS)
    b = etl.build_interactions(spark.read.parquet(flat_path), fx.AS_OF)
    assert rows(a) == rows(b)
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    b = etl.build_interactions(spark.read.parquet(flat_path), fx.AS_OF)
    plan = b._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(sp_app_id" in plan and "EqualTo(page_type,article)" in plan


def test_write_interactions_registers_table(spark):
    df = spark.createDataFrame([("u", "i", 1, "page_view", None, None, None, None, None)],
                               schemas.interactions_csv_schema())
    path = tempfile.mkdtemp(prefix="tbl-") + "/t"
    writers.write_interactions(df, path, table="recoflow_interactions_test")
    writers.write_interactions(df, path, table="recoflow_interactions_test")  # a second run
    try:
        assert spark.table("recoflow_interactions_test").count() == 1
    finally:
        spark.sql("DROP TABLE IF EXISTS recoflow_interactions_test")
