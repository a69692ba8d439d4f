"""Every registered key against its DuckDB oracle on the sf0.001 tables."""

from __future__ import annotations

import math

import pytest

import __spark_entry__ as E
from recoflow import registry
from tests.conftest import SMALL

ORACLE = E.oracle_sql()
KEYS = sorted(ORACLE)


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "as_tuple"):  # Decimal
        return round(float(v), 6)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _canon(cols, recs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted((tuple(_norm(r[i]) for i in order) for r in recs), key=repr)


def test_every_key_of_the_library_has_an_oracle():
    """Queries added where the ``llm`` subpackage is installed may be beyond
    SQL; its own tests hold those against brute force."""
    assert set(registry.queries()) <= set(ORACLE) <= set(E.queries())


@pytest.mark.parametrize("key", KEYS)
def test_key_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SMALL)
    s_cols, s_rows = _canon(df.columns, [tuple(r) for r in df.collect()])
    cur = duck.execute(ORACLE[key])
    d_cols, d_rows = _canon([d[0] for d in cur.description], cur.fetchall())
    assert s_cols == d_cols
    assert len(s_rows) == len(d_rows)
    assert s_rows == d_rows


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:4] == ["USER_ID", "ITEM_ID", "TIMESTAMP", "EVENT_TYPE"]
