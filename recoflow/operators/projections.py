"""Projection operators (ops 11, 12, 26, 29, 56)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recoflow import constants as C

# Default of ``max_keys``: attribute keys that discovery turns into columns.
DEFAULT_MAX_KEYS = 4096


def distinct_attribute_keys(df: DataFrame, map_col: str = "eventAttributes") -> DataFrame:
    """56: the distinct keys of a map column, as a one-column frame ``key``.

    ``explode(map_keys)`` runs on the executors and the ``distinct`` is a
    partial (map-side) aggregation, so only distinct keys cross the shuffle.
    """
    return df.select(F.explode(F.map_keys(map_col)).alias("key")).distinct()


def discover_keys(df: DataFrame, map_col: str = "eventAttributes",
                  max_keys: int = DEFAULT_MAX_KEYS) -> list[str]:
    """Collect the distinct attribute keys for a schema decision.

    Only the distinct key set reaches the driver.  More than ``max_keys`` of
    them are an error, never cut: raise the parameter or pass the keys.
    """
    keys_df = distinct_attribute_keys(df, map_col)
    probe = keys_df.limit(max_keys + 1).collect()
    if len(probe) > max_keys:
        raise ValueError(f"{map_col} has more than {max_keys} distinct keys; "
                         "pass the attribute keys explicitly")
    return sorted(r["key"] for r in probe)


def pivot_attributes(df: DataFrame, keys: Sequence[str] | None = None,
                     map_col: str = "eventAttributes",
                     main_columns: Sequence[str] = C.RAW_MAIN_COLUMNS) -> DataFrame:
    """11: one column per attribute key plus the main columns.

    With ``keys`` given (the usual case: the attribute set is part of the
    event contract) this is a single narrow projection.  Without it the
    keys are discovered first (one extra, cheap aggregation job).  A key
    missing from a row gives NULL.
    """
    if keys is None:
        keys = discover_keys(df, map_col)
    m = F.col(map_col)
    exprs = [m.getItem(k).alias(k) for k in keys]
    extra = [c for c in df.columns if c not in (map_col, *main_columns)]
    return df.select(*exprs, *main_columns, *extra)


# op 12: source column, source type, target column, target type
ITEM_MAPPING = (
    ("keywords", "array<string>", "Keywords", "array<string>"),
    ("category", "string", "Category", "string"),
    ("section", "string", "Section", "string"),
    ("contenttext", "string", "ContentText", "string"),
    ("wordcount", "bigint", "WordCount", "bigint"),
    ("contentid", "string", "ITEM_ID", "string"),
    ("publisheddate", "string", "CREATION_TIMESTAMP", "string"),
    ("sponsored", "boolean", "Sponsored", "int"),
)


def apply_mapping(df: DataFrame, mapping=ITEM_MAPPING) -> DataFrame:
    """12: rename and cast (the catalog's apply-mapping step).

    Boolean to int is a cast (true -> 1), done before any comparison with 1:
    comparing a boolean with an integer fails under ANSI mode.
    """
    return df.select(*[F.col(src).cast(dst_t).alias(dst) for src, _, dst, dst_t in mapping])


def rename_fields(df: DataFrame, renames=C.REPLY_RENAMES) -> DataFrame:
    """26: lower-case every column name, then apply the reply renames."""
    lowered = df.toDF(*[c.lower() for c in df.columns])
    return lowered.withColumnsRenamed({k: v for k, v in renames.items() if k in lowered.columns})


def json_number(c: Column) -> Column:
    """A decimal as a JSON number, by its value: whole ones have no fraction."""
    no_zeros = F.regexp_replace(c.cast("string"), r"(\.\d*?)0+$", "$1")
    return F.parse_json(F.regexp_replace(no_zeros, r"\.$", ""))


def decimal_to_number(df: DataFrame) -> DataFrame:
    """29: decimal columns leave as numbers (variant), whole values as integers."""
    return df.select(*[json_number(F.col(f.name)).alias(f.name)
                       if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
                       for f in df.schema.fields])
