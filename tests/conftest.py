from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"
ORACLE_SF = "/root/testdata/sf0.01"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


@pytest.fixture(scope="session")
def spark():
    from recoflow.session import local_session
    s = local_session(cores=4, shuffle_partitions=4, app="recoflow-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    yield con
    con.close()


def rows(df, *cols):
    """Collected rows as plain tuples, sorted (order-insensitive compare)."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def S(expected):
    """Expected rows in the order ``rows`` returns them."""
    return sorted(expected, key=repr)
