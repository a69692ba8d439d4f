"""Embedding near-dedup by cross-polytope hashing.

Vectors are rotated at random by three rounds of sign flips and a fast
Hadamard transform; the hash is the nearest vertex of the cross-polytope,
that is the largest coordinate and its sign. A table joins several such
hashes, within a label: as many as it takes for a vector to meet about one other by
chance (``joined_hashes``: the width's logarithm of the number of different vectors, two at least), so buckets do
not grow with the table. Each vector stands in the bucket of its hash and,
as further probes, in all those that take the second nearest vertex in any of the joined
hashes, and there are more tables with more hashes, so that recall stays (README). Vectors that meet in a bucket, one of them by its own hash, are compared exactly, in
bounded blocks.

Equal vectors of a label are one class, compared once. A pair that meets
in several buckets is counted in the first.

Cases: an empty table gives no rows; vectors that are null, empty, zero or hold null or non-finite
numbers link with nothing, as do those with a null label; vectors of
different lengths are never compared. Repeated rows are separate vectors
of one class; a null id is the smallest. Only id, label and vector are
read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .buckets import LINKS, by_block, dealt, link_rows, pairs
from .common import NULL_ID, materialize
from .components import components
from .textscan import mix

COSINE = 0.93
TABLES = 7        # tables for each hash joined
MOST_JOINED = 6   # hashes joined at most (64 probes a table; beyond some 10**11 vectors of 64 dimensions buckets grow again, results do not change)
BLOCK = 192


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of every row (length a power of two), orthonormal."""
    n, width, half = len(x), x.shape[1], 1
    while half < width:
        x = x.reshape(n, -1, 2, half)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(n, width)
        half *= 2
    return x / np.sqrt(width)


def vertices(x: np.ndarray, seed: int) -> np.ndarray:
    """(rows, 2): nearest and second nearest vertex (2 * coordinate + sign)."""
    rng = np.random.default_rng(seed)
    for _ in range(3):
        x = hadamard(x * rng.choice([-1.0, 1.0], x.shape[1]))
    size = np.abs(x)
    best = np.argsort(-size, axis=1, kind="stable")[:, :2]
    at = np.arange(len(x))[:, None]
    return 2 * best + (x[at, best] < 0)


def joined_hashes(vectors: int, dimensions: int) -> int:
    """Hashes that a table joins: with width w, two vectors meet by chance in about vectors / w**joined buckets."""
    width = max(2, 1 << max(0, int(dimensions - 1).bit_length()))
    return min(MOST_JOINED, max(2, int(np.ceil(np.log(max(1, vectors)) / np.log(width)))))


def keys_of(x: np.ndarray, label: np.ndarray, tables: int, joined: int = 2) -> np.ndarray:
    """(rows, tables, 2 ** joined) bucket keys; the vector's own first, then with every choice of second vertices."""
    width = max(2, 1 << max(0, int(x.shape[1] - 1).bit_length()))
    x = np.pad(x, ((0, 0), (0, width - x.shape[1])))
    out = np.empty((len(x), tables, 1 << joined), np.int64)
    for t in range(tables):
        chosen = [vertices(x, 7000 + MOST_JOINED * t + k) for k in range(joined)]
        for p in range(1 << joined):
            code = mix(label, 52) ^ np.uint64(width)
            for k, vertex in enumerate(chosen):
                code = mix(code ^ mix(vertex[:, p >> k & 1].astype(np.uint64), 51 + k), 60)
            out[:, t, p] = mix(code + np.uint64(t), 53).view(np.int64)
    return out


def _hash_rows(tables: int, joined: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2).to_pylist()
            label = np.array([v for v in batch.column(1).to_pylist()], np.int64).view(np.uint64)
            for size in sorted({len(v) for v in lists}):
                rows = np.flatnonzero([len(v) == size for v in lists])
                x = np.array([lists[i] for i in rows], np.float64)
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                keys = keys_of(x, label[rows], tables, joined)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), pa.array(keys.reshape(len(rows), -1).tolist(), pa.list_(pa.int64()))],
                                                 names=["node", "keys"])
    return run


def _met(keys: np.ndarray, bucket: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Mask of the pairs whose first common bucket (own with own, or own with a probe) is this one."""
    tables = keys.shape[1]
    done = np.zeros(len(i), bool)
    mine = np.zeros(len(i), bool)
    for t in range(tables):
        a, b = keys[i, t], keys[j, t]
        for key, other in ((a[:, 0], b), (b[:, 0], a)):
            meet = (other == key[:, None]).any(axis=1) & ~done
            mine |= meet & (key == bucket)
            done |= meet
    return mine


def dedup_embeddings(vectors: DataFrame, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding",
                     cosine: float = COSINE, limit: int = BLOCK) -> DataFrame:
    """(id, n_links, component_id, kept) of every row."""
    x = F.col(vector_col)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    usable = F.coalesce(x.isNotNull() & F.col(label_col).isNotNull() & finite & F.exists(x, lambda v: v != 0), F.lit(False))
    words = F.transform(x, lambda v: v.cast("double") + F.lit(0.0))
    rows = vectors.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("_id"),
        F.when(usable, F.xxhash64(F.col(label_col).cast("string"))).alias("_label"),
        F.when(usable, F.md5(F.concat_ws(",", F.col(label_col).cast("string"), F.array_join(words.cast("array<string>"), ",")))).alias("_class"),
        F.when(usable, words).alias("_x"))
    classes = materialize(
        rows.where("_class IS NOT NULL").groupBy("_class").agg(
            F.min("_id").alias("_id"), F.count("*").alias("members"), F.first("_label").alias("_label"), F.first("_x").alias("_x"))
        .withColumn("node", F.monotonically_increasing_id()), "vectors")
    # by the largest group of vectors that can meet: of one label and length
    groups = classes.groupBy("_label", F.size("_x").alias("size")).count()
    need = F.log("count") / F.log(F.greatest(F.lit(2), F.col("size")).cast("double"))
    most = groups.agg(F.max(F.struct(need.alias("need"), "count", "size")).alias("of")).first().of
    joined = joined_hashes(most["count"], most["size"]) if most else 2
    tables = TABLES * joined
    keyed = materialize(classes.select("node", "_label", "_x").mapInArrow(_hash_rows(tables, joined), "node long, keys array<long>"), "keys")
    entries = keyed.select("node", F.posexplode("keys").alias("slot", "bucket"))
    own = (F.col("slot") % (1 << joined) == 0).cast("int")
    counts = entries.groupBy("bucket").agg(F.count("*").alias("size"), F.sum(own).alias("own")).where("size > 1 AND own > 0").drop("own")
    met = entries.select("node", "bucket").distinct().join(counts, "bucket")
    spread = dealt(met, limit).join(classes.select("node", "members", "_x").join(keyed, "node"), "node")

    def verify(table: pa.Table) -> pa.Table | None:
        lists = table.column("_x").to_pylist()
        i, j = pairs(table)
        sizes = np.array([len(v) for v in lists])
        if len(set(sizes.tolist())) > 1:  # never met by hashing but by chance
            same = sizes[i] == sizes[j]
            i, j = i[same], j[same]
        v = np.zeros((len(lists), int(sizes.max())))
        for k, values in enumerate(lists):
            v[k, : len(values)] = values
        near = np.zeros(len(i), bool)
        norm = np.sqrt((v * v).sum(axis=1))
        near = (v @ v.T)[i, j] / (norm[i] * norm[j]) >= cosine
        i, j = i[near], j[near]
        keys = np.array(table.column("keys").to_pylist(), np.int64).reshape(len(lists), tables, 1 << joined)
        first = _met(keys, table.column("bucket")[0].as_py(), i, j)
        return link_rows(table.column("node").to_numpy(), table.column("members").to_numpy().astype(float), i[first], j[first])

    linked = materialize(by_block(spread, verify, LINKS), "linked")
    found = linked.groupBy("node").agg(F.sum("links").alias("links"))
    parts = components(linked.select(F.col("node").alias("a"), F.col("other").alias("b")))
    named = classes.select("node", "_class", "_id", "members").join(parts, "node", "left").join(found, "node", "left")
    named = named.withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("_id").alias("least"))
    told = materialize(named.join(least, "component").select(
        "_class", "least", (F.coalesce("links", F.lit(0)) + F.col("members") - 1).alias("links")), "told")
    out = rows.select("_id", "_class").join(told, "_class", "left").withColumn("least", F.coalesce("least", "_id"))
    null = lambda c: F.when(c == NULL_ID, None).otherwise(c)
    return out.select(null(F.col("_id")).alias(id_col), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                      null(F.col("least")).alias("component_id"), (F.col("_id") == F.col("least")).alias("kept"))
