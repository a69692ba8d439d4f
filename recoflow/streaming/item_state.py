"""Item state of the content stream (ops 74, 76): the newest properties of every item, kept as runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recoflow.streaming.runs import Runs

ITEM_STATE_COLUMNS = ("itemId", "updated_ts", "record_id", "properties")


def upsert_items(current: DataFrame | None, updates: DataFrame, key: str = "itemId",
                 version: tuple[str, ...] = ("updated_ts", "record_id")) -> DataFrame:
    """74: newest properties per item win.

    ``max(struct(version..., payload))`` per key is an ordinary aggregate,
    so it is combined map-side: a key updated a million times costs one
    row per map task in the shuffle, not a million.
    """
    rows = updates if current is None else current.unionByName(updates)
    payload = [c for c in rows.columns if c != key and c not in version]
    best = F.max(F.struct(*[F.col(v) for v in version], *[F.col(c) for c in payload]))
    return rows.groupBy(key).agg(best.alias("b")).select(
        key, *[F.col(f"b.{c}").alias(c) for c in (*version, *payload)])


class ItemState(Runs):
    columns = ITEM_STATE_COLUMNS
    key = ("itemId",)

    def combine(self, rows: DataFrame) -> DataFrame:
        return upsert_items(None, rows)
