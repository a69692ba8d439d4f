"""Domain tables derived from the generic test tables.

The deployment reads raw click events, article metadata, image metadata,
a settings table and a stream of requests.  The test harness ships generic
tables instead (``events``, ``documents``, ``customer``, ``region``), so this
module derives rows with the domain shapes from them.

Each derivation is a list of ``(sql_expression, alias)`` pairs written in
the SQL subset shared by Spark and DuckDB.  Spark applies it with
``selectExpr``; the DuckDB oracle (``recoflow.oracle``) renders the very same
text as a CTE, so both engines see identical inputs.  Only integer
arithmetic, CASE, concatenation and casts are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recoflow.constants import APP_ID, RAW_MAIN_COLUMNS

# -- events_flat: one row per click event, every attribute a string --------
EVENTS_FLAT = [
    ("CAST(event_id AS STRING)", "sp_event_id"),
    ("CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 41 = 0 THEN '' "
     "ELSE 'u' || CAST(user_id AS STRING) END", "sp_user_id"),
    ("CASE WHEN event_id % 35 = 0 THEN NULL ELSE 'd' || CAST(user_id AS STRING) END",
     "sp_domain_userid"),
    ("CASE WHEN event_id % 97 = 0 THEN 'garbage' "
     "ELSE replace(substr(CAST(ts AS STRING), 1, 19), ' ', 'T') || '.000Z' END",
     "sp_derived_tstamp"),
    ("CASE WHEN event_id % 29 = 0 THEN NULL WHEN event_id % 31 = 0 THEN 'http://x/y' "
     "ELSE 'doc' || regexp_extract(props, '[0-9]+', 0) END", "content_contentid"),
    ("CASE WHEN event_type IN ('view', 'click') THEN 'page_view' ELSE event_type END",
     "sp_event_name"),
    (f"CASE WHEN event_id % 37 = 0 THEN 'other-app' ELSE '{APP_ID}' END",
     "sp_app_id"),
    ("CASE WHEN event_id % 11 = 0 THEN 'section' ELSE 'article' END", "page_type"),
    ("CASE WHEN user_id % 3 = 0 THEN 'Anonymous' WHEN user_id % 3 = 1 THEN 'Registered' "
     "ELSE 'Subscribed' END", "visitor_type"),
    ("CASE WHEN user_id % 4 = 0 THEN NULL ELSE 'CA' END", "visitor_countrycode"),
    ("CASE WHEN event_id % 23 = 0 THEN 'PREMIUM~PREMIUM~~~~~' WHEN event_id % 2 = 0 THEN NULL "
     "ELSE 'BASIC' END", "visitor_servicecode"),
    ("CASE WHEN event_id % 13 = 0 THEN 'Bot' WHEN event_id % 7 = 0 THEN NULL "
     "WHEN event_id % 2 = 0 THEN 'Mobile' ELSE 'Desktop' END", "device_detector_visitorplatform"),
    ("CASE WHEN user_id % 2 = 0 THEN 'Apple' ELSE 'Samsung' END", "device_detector_brandname"),
    ("CASE WHEN user_id % 2 = 0 THEN 'Safari' ELSE 'Chrome' END", "device_detector_browserfamily"),
    ("CASE WHEN event_id % 17 = 0 THEN 'Googlebot' WHEN event_id % 3 = 0 THEN NULL "
     "ELSE 'Bell' END", "sp_ip_isp"),
    ("CASE WHEN event_id % 19 = 0 THEN 'localhost' WHEN event_id % 4 = 0 THEN NULL "
     "ELSE 'www.example.com' END", "sp_page_urlhost"),
    ("CASE WHEN event_id % 43 = 0 THEN NULL ELSE 's' || CAST(user_id AS STRING) END",
     "sp_domain_sessionid"),
    ("CASE WHEN event_id % 10 = 0 THEN 'r' || CAST(event_id AS STRING) END", "page_rid"),
    # top-level columns of a raw batch event and its partition columns
    ("CAST(ts AS STRING)", "timestamp"),
    ("CAST(ts AS STRING)", "datetime_collector_local"),
    ("CAST(CAST(ts AS DATE) AS STRING)", "eventdate"),
    ("CAST(ts AS STRING)", "datetime_local"),
    ("CAST(year(ts) AS INT)", "year"),
    ("CAST(month(ts) AS INT)", "month"),
    ("CAST(day(ts) AS INT)", "day"),
]

# The attributes a batch event carries inside its ``eventAttributes`` map.
BATCH_ATTRIBUTE_KEYS = [
    "sp_user_id", "sp_domain_userid", "sp_derived_tstamp", "content_contentid",
    "sp_event_name", "sp_app_id", "page_type", "visitor_type", "visitor_countrycode",
    "visitor_servicecode", "device_detector_visitorplatform", "device_detector_brandname",
    "device_detector_browserfamily", "sp_ip_isp", "sp_page_urlhost",
]

# Stream records use camel case for some of the same attributes.
STREAM_NAME = {
    "content_contentid": "content_contentId",
    "device_detector_visitorplatform": "device_detector_visitorPlatform",
    "visitor_countrycode": "visitor_countryCode",
    "device_detector_brandname": "device_detector_brandName",
    "device_detector_browserfamily": "device_detector_browserFamily",
}
STREAM_EVENT_KEYS = ["sp_event_id"] + BATCH_ATTRIBUTE_KEYS + ["sp_domain_sessionid", "page_rid"]

# -- items_flat: article metadata as the batch item job reads it -----------
ITEMS_FLAT = [
    ("'doc' || CAST(doc_id AS STRING)", "contentid"),
    ("CASE WHEN doc_id % 47 = 0 THEN NULL ELSE text END", "contenttext"),
    ("CASE WHEN doc_id % 8 = 0 THEN 'canada' WHEN doc_id % 8 = 1 THEN 'world' "
     "WHEN doc_id % 8 = 2 THEN 'business' WHEN doc_id % 8 = 3 THEN 'investing' "
     "WHEN doc_id % 8 = 4 THEN 'politics' WHEN doc_id % 8 = 5 THEN 'sports' "
     "WHEN doc_id % 8 = 6 THEN 'arts' ELSE 'opinion' END", "category"),
    ("CASE WHEN doc_id % 23 = 0 THEN 'life/horoscopes' ELSE 'news' END", "section"),
    ("CASE WHEN doc_id % 29 = 0 THEN NULL WHEN doc_id % 13 = 0 THEN 'omit' "
     "WHEN doc_id % 17 = 0 THEN 'zerocanada|budget' WHEN doc_id % 19 = 0 THEN 'omitted' "
     "ELSE 'climate|environment' END", "keywords_text"),
    ("n_chars", "wordcount"),
    ("CASE WHEN doc_id % 53 = 0 THEN 'garbage' ELSE "
     "CAST(DATE '2024-01-31' - CAST(doc_id % 30 AS INT) AS STRING) || 'T06:00:00.000Z' END",
     "publisheddate"),
    ("doc_id % 10 = 0", "sponsored"),
    ("doc_id", "doc_id"),
]

# -- content_flat: the stream form of an article update (before JSON) -------
# Derived from items_flat (column names as above).
CONTENT_FLAT = [
    ("CASE WHEN doc_id % 61 = 0 THEN NULL ELSE contentid END", "ContentId"),
    ("CASE WHEN doc_id % 67 = 0 THEN NULL ELSE category END", "Category"),
    ("section", "Section"),
    ("contenttext", "ContentText"),
    ("CASE WHEN doc_id % 4 = 0 THEN 'blog' ELSE 'news' END", "ContentType"),
    ("publisheddate", "UpdatedDate"),
    ("CASE WHEN doc_id % 37 = 0 THEN NULL ELSE doc_id % 11 <> 0 END", "Published"),
    ("sponsored", "Sponsored"),
    ("keywords_text", "keywords_text"),
    ("wordcount", "WordCount"),
    ("doc_id", "doc_id"),
]

# -- content_meta: the 19 reply attributes of an article --------------------
# Derived from items_flat.  Byline / Keywords arrays are added per engine.
CONTENT_META = [
    ("contentid", "ContentId"),
    ("'Title ' || CAST(doc_id AS STRING)", "Title"),
    ("CASE WHEN doc_id % 6 = 0 THEN NULL ELSE 'Deck of ' || contentid END", "Deck"),
    ("category", "Category"),
    ("section", "Section"),
    ("'published'", "State"),
    ("'https://news.example/' || category || '/' || contentid", "CanonicalURL"),
    ("CASE WHEN doc_id % 4 = 0 THEN NULL ELSE 'Staff' END", "CreditLine"),
    ("'owned'", "Ownership"),
    ("sponsored", "Sponsored"),
    ("CASE WHEN doc_id % 4 = 0 THEN 'blog' ELSE 'news' END", "ContentType"),
    ("CASE WHEN doc_id % 2 = 0 THEN 'free' ELSE 'registered' END", "ContentRestriction"),
    ("publisheddate", "PublishedDate"),
    ("CAST(wordcount AS DECIMAL(18, 2)) / 4", "WordCount"),
    ("CASE WHEN doc_id % 5 = 0 THEN NULL ELSE 'Photo ' || contentid END", "Caption"),
    ("publisheddate", "UpdatedDate"),
    ("CASE WHEN doc_id % 9 = 0 THEN 'Analysis' END", "Label"),
    ("doc_id", "doc_id"),
]

# -- requests_flat: one recommendation request per customer ----------------
REQUESTS_FLAT = [
    ("c_custkey", "request_id"),
    ("'u' || CAST(c_custkey AS STRING)", "visitor_id"),
    ("CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN 'x' "
     "ELSE CAST(c_custkey % 30 + 1 AS STRING) END", "limit_text"),
    ("CASE WHEN c_custkey % 3 = 0 THEN 'art_same_section_mostpopular' "
     "WHEN c_custkey % 3 = 1 THEN 'mobile_art_morestories' ELSE 'art_mostpopular' END", "context"),
    ("CASE WHEN c_custkey % 2 = 0 THEN 'desktop' ELSE 'MOBILE' END", "platform"),
    ("CASE WHEN c_custkey % 4 = 0 THEN '/canada/alberta' WHEN c_custkey % 4 = 1 "
     "THEN 'report-on-business' WHEN c_custkey % 4 = 2 THEN '/globe-investor/' END", "section"),
    ("CASE WHEN c_custkey % 6 = 0 THEN 'sports' END", "include_sections"),
    ("'doc' || CAST(c_custkey % 100 AS STRING)", "last_content_ids"),
    ("CASE WHEN c_custkey % 3 = 0 THEN 'anonymous' WHEN c_custkey % 3 = 1 THEN 'REGISTERED' END",
     "visitor_type"),
    ("'recommended-' || CASE WHEN c_custkey % 2 = 0 THEN 'art' ELSE 'home' END", "widget_id"),
]

# -- settings: one backend per region row ------------------------------------
SETTINGS_FLAT = [
    ("'grp-' || lower(replace(r_name, ' ', '-'))", "name"),
    ("CASE WHEN r_regionkey = 4 THEN 'inactive' ELSE 'active' END", "status"),
    ("'trk-' || CAST(r_regionkey AS STRING)", "eventTrackerId"),
    ("'dataset/grp-' || lower(replace(r_name, ' ', '-')) || '/ITEMS'", "datasetArn"),
    ("'campaign/grp-' || lower(replace(r_name, ' ', '-')) || '-userPersonalizationCampaign'",
     "campaignArn"),
    ("CAST(CASE r_regionkey WHEN 0 THEN 100 WHEN 1 THEN 99 WHEN 2 THEN 1 WHEN 3 THEN 50 "
     "ELSE 10 END AS INT)", "trafficRatio"),
    ("CAST(r_regionkey AS INT)", "backend_order"),
]

AS_OF = "2024-01-31"

# The article an image-metadata row belongs to: some rows name no article we
# know, so some articles have no images row.
IMAGE_CONTENT_ID = ("CASE WHEN doc_id % 17 = 3 THEN 'archive' ELSE 'doc' END || "
                    "CAST(doc_id AS {text})")

# The recommendation id of an event (same rule as events_flat.page_rid).
PAGE_RID = dict((a, e) for e, a in EVENTS_FLAT)["page_rid"]


def select_exprs(df: DataFrame, exprs: list[tuple[str, str]]) -> DataFrame:
    return df.selectExpr(*[f"{e} AS `{a}`" for e, a in exprs])


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select_exprs(read(spark, sf_dir, "events"), EVENTS_FLAT)


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch raw events: attribute map + 4 main columns + date partitions.

    Absent attributes are absent keys (NULL values are not stored).
    """
    flat = events_flat(spark, sf_dir)
    entries = F.array(*[F.struct(F.lit(k).alias("key"), F.col(k).alias("value"))
                        for k in BATCH_ATTRIBUTE_KEYS])
    attrs = F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull()))
    return flat.select(attrs.alias("eventAttributes"), *RAW_MAIN_COLUMNS, "year", "month", "day")


def stream_event_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream records: camel-case JSON, base64 text in ``data``."""
    flat = events_flat(spark, sf_dir)
    body = F.to_json(F.struct(*[F.col(k).alias(STREAM_NAME.get(k, k)) for k in STREAM_EVENT_KEYS]))
    return flat.select(F.col("sp_event_id").alias("record_id"),
                       F.base64(F.encode(body, "UTF-8")).alias("data"))


def items_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select_exprs(read(spark, sf_dir, "documents"), ITEMS_FLAT)


def raw_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch content metadata as the catalog exposes it (lower-case names)."""
    return items_flat(spark, sf_dir).select(
        F.split("keywords_text", "[|]").alias("keywords"),
        "category", "section", "contenttext", "contentid", "publisheddate",
        "wordcount", "sponsored")


def content_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = select_exprs(items_flat(spark, sf_dir), CONTENT_FLAT)
    return flat.withColumn("Keywords", F.split("keywords_text", "[|]")).drop("keywords_text")


def stream_content_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = content_flat(spark, sf_dir)
    keys = ["ContentId", "Category", "Section", "ContentText", "ContentType", "UpdatedDate",
            "Published", "Sponsored", "Keywords", "WordCount"]
    body = F.to_json(F.struct(*keys))
    return flat.select(F.col("doc_id").cast("string").alias("record_id"),
                       F.base64(F.encode(body, "UTF-8")).alias("data"))


def content_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = items_flat(spark, sf_dir)
    meta = select_exprs(items, CONTENT_META + [("keywords_text", "keywords_text")])
    byline = (F.when(F.col("doc_id") % 11 == 0, F.lit(None).cast("array<string>"))
              .when(F.col("doc_id") % 3 == 0, F.array().cast("array<string>"))
              .when(F.col("doc_id") % 3 == 1,
                    F.array(F.concat(F.lit("Author "), (F.col("doc_id") % 7).cast("string"))))
              .otherwise(F.array(F.lit("Author A"), F.lit("Author B"))))
    return (meta.withColumn("Byline", byline)
            .withColumn("Keywords", F.split("keywords_text", "[|]"))
            .drop("keywords_text"))


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Image metadata of every article; some rows carry an archive id, so
    some articles have no images row of their own."""
    docs = read(spark, sf_dir, "documents").select("doc_id")
    did = F.col("doc_id").cast("string")

    def url(kind: str, n: int):
        return F.struct(F.concat(F.lit(f"https://img.example/{kind}{n}/"), did, F.lit(".jpg"))
                        .alias("url220"))

    null_url = F.struct(F.lit(None).cast("string").alias("url220"))
    author = (F.when(F.col("doc_id") % 7 == 0, F.lit(None))
              .when(F.col("doc_id") % 5 == 0, F.array().cast("array<struct<url220:string>>"))
              .when(F.col("doc_id") % 13 == 0, F.array(null_url))
              .otherwise(F.array(url("a", 1))))
    picture = (F.when(F.col("doc_id") % 4 == 0, F.array().cast("array<struct<url220:string>>"))
               .otherwise(F.array(url("p", 1), url("p", 2))))
    return docs.select(F.expr(IMAGE_CONTENT_ID.format(text="STRING")).alias("ContentID"),
                       author.alias("AuthorRel"), picture.alias("PictureRel"))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests in the API shape: visitor + an array of sub-requests."""
    flat = select_exprs(read(spark, sf_dir, "customer"), REQUESTS_FLAT)
    sub = F.struct(
        F.col("widget_id"), F.col("limit_text").alias("limit"), F.col("context"),
        F.col("platform"), F.col("visitor_type"), F.col("section"),
        F.col("include_sections"), F.col("last_content_ids"))
    return flat.select("request_id", "visitor_id", "platform", F.array(sub).alias("sub_requests"))


def settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select_exprs(read(spark, sf_dir, "region"), SETTINGS_FLAT)


# -- metrics: monitoring samples derived from the events -------------------------
METRIC_NAME = ("CASE event_type WHEN 'view' THEN 'GetRecommendations' "
               "WHEN 'click' THEN 'MissingRecommendations' WHEN 'error' THEN 'PutEventsErrors' "
               "WHEN 'purchase' THEN 'PutContentErrors' ELSE 'GetRecommendationsErrors' END")
METRIC_VALUE = "CASE WHEN event_type = 'view' THEN 1.0 ELSE value END"


def metrics_from_events(events: DataFrame) -> DataFrame:
    """(ts epoch seconds, metric, value): one sample per event, plus a
    RecommendationsUsed sample for every event carrying a recommendation id."""
    ts = F.unix_timestamp(F.col("ts").cast("timestamp"))
    main = events.select(ts.alias("ts"), F.expr(METRIC_NAME).alias("metric"),
                         F.expr(METRIC_VALUE).cast("double").alias("value"))
    used = events.filter(F.expr(PAGE_RID).isNotNull()).select(
        ts.alias("ts"), F.lit("RecommendationsUsed").alias("metric"), F.lit(1.0).alias("value"))
    return main.unionByName(used)
