"""Schemas of the domain datasets.

Stream payloads are parsed with explicit schemas (no inference on a
stream).  The two output datasets carry an Avro-style field list, as the
downstream import declares them; ``validate_dataset`` checks rows
against it.
"""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()

# ---------------------------------------------------------------------------
# FIXED VALUES: field names of the stream payloads
# ---------------------------------------------------------------------------
STREAM_EVENT = T.StructType([
    T.StructField(n, S) for n in (
        "sp_event_id", "sp_user_id", "sp_domain_userid", "sp_derived_tstamp",
        "content_contentId", "sp_event_name", "sp_app_id", "page_type", "visitor_type",
        "visitor_countryCode", "visitor_servicecode", "device_detector_visitorPlatform",
        "device_detector_brandName", "device_detector_browserFamily", "sp_ip_isp",
        "sp_page_urlhost", "sp_domain_sessionid", "page_rid")
])

STREAM_CONTENT = T.StructType([
    T.StructField("ContentId", S),
    T.StructField("Category", S),
    T.StructField("Section", S),
    T.StructField("ContentText", S),
    T.StructField("ContentType", S),
    T.StructField("UpdatedDate", S),
    T.StructField("Published", T.BooleanType()),
    T.StructField("Sponsored", T.BooleanType()),
    T.StructField("Keywords", T.ArrayType(S)),
    T.StructField("WordCount", T.LongType()),
])

# ---------------------------------------------------------------------------

# Raw stream record as it arrives: an id and base64 text.
STREAM_RECORD = T.StructType([
    T.StructField("record_id", S),
    T.StructField("data", S),
])

# ---------------------------------------------------------------------------
# FIXED VALUES: dataset schemas of the import contract (field, type, nullable)
# ---------------------------------------------------------------------------
INTERACTIONS_FIELDS = (
    ("USER_ID", "string", False),
    ("ITEM_ID", "string", False),
    ("TIMESTAMP", "long", False),
    ("EVENT_TYPE", "string", False),
    ("visitor_type", "string", True),
    ("visitor_countrycode", "string", True),
    ("device_detector_visitorplatform", "string", True),
    ("device_detector_brandname", "string", True),
    ("device_detector_browserfamily", "string", True),
)

ITEMS_FIELDS = (
    ("ITEM_ID", "string", False),
    ("CREATION_TIMESTAMP", "long", False),
    ("ContentText", "string", True),
    ("Category", "string", True),
    ("WordCount", "int", True),
    ("Exclude", "int", True),
)

# Flags of fields for the import: how the downstream service uses them.
FIELD_FLAGS = {
    "visitor_type": "categorical",
    "visitor_countrycode": "categorical",
    "device_detector_visitorplatform": "categorical",
    "device_detector_brandname": "categorical",
    "device_detector_browserfamily": "categorical",
    "ContentText": "textual",
    "Category": "categorical",
}

# ---------------------------------------------------------------------------

_FLAG_NAMES = ("categorical", "textual")
_AVRO_TO_SPARK = {"string": "string", "long": "bigint", "int": "int", "boolean": "boolean",
                  "double": "double", "float": "float"}
_SPARK_TYPES = {"string": T.StringType(), "bigint": T.LongType(), "long": T.LongType(),
                "int": T.IntegerType(), "boolean": T.BooleanType(), "double": T.DoubleType(),
                "float": T.FloatType()}


def avro_fields(schema_json: dict) -> tuple[tuple[str, str, bool], ...]:
    """Avro-style record JSON -> (name, spark type, nullable) triples."""
    out = []
    for f in schema_json["fields"]:
        t = f["type"]
        nullable = isinstance(t, list) and "null" in t
        base = [x for x in t if x != "null"][0] if isinstance(t, list) else t
        out.append((f["name"], _AVRO_TO_SPARK[base], nullable))
    return tuple(out)


def struct_of(fields, flags=None) -> T.StructType:
    """Fields (name, type, nullable) as a schema; ``flags``: name -> flag, kept as the field's metadata."""
    flags = FIELD_FLAGS if flags is None else flags
    return T.StructType([T.StructField(n, _SPARK_TYPES[t], nl, {flags[n]: True} if n in flags else None) for n, t, nl in fields])


def dataset_schema(schema_json: dict) -> T.StructType:
    """A declared dataset schema (record JSON) as a Spark schema; a field's flags become its metadata."""
    out = T.StructType()
    for field, (name, typ, nullable) in zip(schema_json["fields"], avro_fields(schema_json)):
        out.add(name, _SPARK_TYPES[typ], nullable, {k: True for k in _FLAG_NAMES if field.get(k)} or None)
    return out


def flag_of(field: T.StructField) -> str | None:
    return next((k for k in _FLAG_NAMES if field.metadata.get(k)), None)


INTERACTIONS = struct_of(INTERACTIONS_FIELDS)
ITEMS = struct_of(ITEMS_FIELDS)


def text_schema(fields) -> T.StructType:
    """The fields as text, for the checks at import."""
    return T.StructType([T.StructField(n, S) for n, _, _ in fields])


def interactions_csv_schema() -> T.StructType:
    return T.StructType([T.StructField(n, _SPARK_TYPES[t], True) for n, t, _ in INTERACTIONS_FIELDS])


def items_csv_schema() -> T.StructType:
    return T.StructType([
        T.StructField("ITEM_ID", S), T.StructField("CREATION_TIMESTAMP", T.LongType()),
        T.StructField("ContentText", S), T.StructField("Category", S),
        T.StructField("WordCount", T.LongType()), T.StructField("Exclude", T.IntegerType()),
    ])
