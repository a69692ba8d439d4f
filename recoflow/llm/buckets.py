"""Work on pairs inside buckets, in bounded blocks.

A bucket of at most ``limit`` rows is one block. A larger one is dealt
into sub-buckets, and each pair of sub-buckets is a block of its own, so
that neither a task nor memory grows with the largest bucket, and every
pair of its rows still meets exactly once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = ["bucket", "left", "right"]


def sized(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with ``size``, the rows of their key; single rows go."""
    return rows.join(rows.groupBy(*keys).agg(F.count("*").alias("size")).where("size > 1"), keys)


def dealt(rows: DataFrame, limit: int) -> DataFrame:
    """Add left, right and side to rows with bucket, node and size: one row for each block of the row."""
    parts = F.ceil(F.col("size") / limit).cast("long")
    rows = rows.withColumn("_parts", parts).withColumn("side", F.pmod(F.xxhash64("node", F.lit(7)), F.col("_parts")))
    rows = rows.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1)))
    return rows.withColumns({"left": F.least("side", "_other"), "right": F.greatest("side", "_other")}).drop("_parts", "_other")


def by_block(rows: DataFrame, fn: Callable[[pa.Table], pa.Table | None], schema: str) -> DataFrame:
    """Apply ``fn`` to the rows of each block; many blocks share a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _blocks(batches):
            out = fn(table)
            if out is not None and len(out):
                yield from out.to_batches()

    return rows.repartition(*BLOCK).sortWithinPartitions(*BLOCK).mapInArrow(_joined(run), schema)


def _joined(run, rows: int = 4096):
    """Many small batches become few."""
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in run(batches):
            held.append(batch)
            count += batch.num_rows
            if count >= rows:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, count = [], 0
        if held:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
    return wrapped


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table])
        key = np.stack([table.column(c).to_numpy() for c in BLOCK])
        edges = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
        start = 0
        for end in edges.tolist():
            yield table.slice(start, end - start)
            start = end
        rest = table.slice(start)
    if rest is not None and len(rest):
        yield rest


def pairs(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of all pairs of a block that are its own."""
    side = table.column("side").to_numpy()
    left, right = table.column("left")[0].as_py(), table.column("right")[0].as_py()
    if left == right:
        return np.triu_indices(len(table), 1)
    a, b = np.flatnonzero(side == left), np.flatnonzero(side == right)
    return np.repeat(a, len(b)), np.tile(b, len(a))


def link_rows(nodes: np.ndarray, weights: np.ndarray, i: np.ndarray, j: np.ndarray) -> pa.Table | None:
    """(node, links, other): for each linked row the weight of its partners in this
    block, and one node of its part of the block's links (a forest, not all pairs)."""
    if not len(i):
        return None
    n = len(nodes)
    links = np.bincount(i, weights=weights[j], minlength=n) + np.bincount(j, weights=weights[i], minlength=n)
    root = np.arange(n)
    while True:  # the smallest row reachable, by repeated hooking
        low = np.minimum(root[i], root[j])
        after = root.copy()
        np.minimum.at(after, i, low)
        np.minimum.at(after, j, low)
        after = after[after]
        if (after == root).all():
            break
        root = after
    own = np.flatnonzero(links > 0)
    return pa.table({"node": nodes[own], "links": links[own].astype(np.int64), "other": nodes[root[own]]})


LINKS = "node long, links long, other long"
