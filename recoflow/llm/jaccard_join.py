"""N-gram Jaccard join by chosen paths.

Documents with the same set of word n-grams are one class; a class is
represented once. Each class's set is embedded into ``TOKENS`` sampled
tokens (min-hashes): two sets share a sampled token with the probability
of their Jaccard similarity. A run is a tree: level by level every bucket
larger than ``limit`` is split on the next sampled token, so that members
of a bucket share a path of tokens; small buckets are leaves, compared by
brute force, and what is still large after ``DEPTH`` splits is compared
in bounded blocks. Every run has min-hashes of its own, so the trees are
independent: all of them miss a pair at the threshold with probability
``(1 - t ** d) ** runs`` after ``d`` splits, at most 8e-8 at ``DEPTH``,
however large the buckets are.

A pair that shares leaves of several runs is compared in the first one
only. A leaf compares the sampled tokens; only documents with a promising
partner there bring their text, and similarity is then exact.

Cases: an empty table gives no rows; null or wordless texts have no n-grams and no links. Texts shorter
than ``n`` words have one n-gram, the whole text. Repeated rows are
separate documents of one class. Null ids are the smallest. Only id and
text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .buckets import LINKS, by_block, dealt, link_rows, pairs, sized
from .common import NULL_ID, discard, doc_key, materialize, text_slices
from .components import components
from .textscan import Words, mix

WORDS = 5
SIMILARITY = 0.8
RUNS = 16
DEPTH = 2
TOKENS = 64  # of which the runs' trees split on DEPTH each
LEAF = 192
#: Equal sampled tokens below which a pair at the threshold is met less than once in a billion.
_PROMISING = 30


def shingles(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct n-grams of every row, by row."""
    hashes = words.hashes()
    at, grams = words.windows(hashes, n)
    doc = words.doc[at]
    short = np.flatnonzero((words.count > 0) & (words.count < n))
    whole = np.zeros(len(short), np.uint64)
    for k, row in enumerate(short.tolist()):  # fewer than n words each
        for h in hashes[words.first[row]: words.first[row + 1]].tolist():
            whole[k: k + 1] = mix(whole[k: k + 1] ^ np.uint64(h), 12)
    doc, grams = np.concatenate([doc, short]), np.concatenate([grams, whole])
    order = np.lexsort((grams, doc))
    doc, grams = doc[order], grams[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (grams[1:] != grams[:-1])
    return doc[new], grams[new]


def _samplers() -> np.ndarray:
    return mix(np.arange(1, TOKENS + 1, dtype=np.uint64), 21) | np.uint64(1)


def _embedder(n: int):
    def embed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = _samplers()
        for batch in batches:
            for at, rows in text_slices(batch.column(2)):
                doc, grams = shingles(Words(rows), n)
                first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]]) if len(doc) else np.zeros(0, np.int64)
                own = doc[first]
                count = np.zeros(len(rows), np.int64)
                low, high = np.zeros(len(rows), np.uint64), np.zeros(len(rows), np.uint64)
                tokens = np.zeros((len(rows), TOKENS), np.uint32)
                if len(first):
                    count[own] = np.diff(np.append(first, len(doc)))
                    low[own] = mix(np.add.reduceat(mix(grams, 31), first))
                    high[own] = mix(np.add.reduceat(mix(grams, 32), first))
                    for k, f in enumerate(factors):
                        tokens[own, k] = np.minimum.reduceat((grams * f) >> np.uint64(32), first).astype(np.uint32)
                raw = tokens.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(rows)), batch.column(1).slice(at, len(rows)), pa.array(count),
                     pa.array(low.view(np.int64)), pa.array(high.view(np.int64)),
                     pa.array([raw[i * 4 * TOKENS: (i + 1) * 4 * TOKENS] for i in range(len(rows))], pa.binary())],
                    names=["_id", "_th", "n", "low", "high", "tokens"])
    return embed


def _paths(runs: int, depth: int):
    """Keys of the nodes of every run's tree that a class would pass; no two runs split on the same token."""
    if runs * depth > TOKENS:
        raise ValueError(f"{runs} runs of {depth} splits need more than {TOKENS} sampled tokens")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32).reshape(-1, TOKENS).astype(np.uint64)
            for run in range(runs):
                chosen = range(run * depth, (run + 1) * depth)
                key, keys = np.full(len(tokens), run, np.uint64), []
                for level in chosen:
                    key = mix(mix(key, 41) ^ tokens[:, level], 42)
                    keys.append(pa.array(key.view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(tokens), run, np.int32)), batch.column(0), *keys],
                                                 names=["run", "node", *(f"k{d}" for d in range(depth))])
    return walk


def _leaves(walked: DataFrame, limit: int, depth: int) -> DataFrame:
    """(run, node, bucket, size): split level by level while a bucket is too large."""
    out, left = [], walked
    for level in range(depth):
        key = f"k{level}"
        counted = materialize(sized(left, [key]), "paths")
        done = counted if level == depth - 1 else counted.where(F.col("size") <= limit)
        out.append(done.select("run", "node", F.col(key).alias("bucket"), "size"))
        left = counted.where(F.col("size") > limit).drop("size")
        if level < depth - 1 and left.isEmpty():
            break
    leaves = out[0]
    for more in out[1:]:
        leaves = leaves.unionByName(more)
    return leaves


def _first_shared(leaves: np.ndarray, run: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Mask of the pairs that share no leaf of an earlier run."""
    fresh = np.ones(len(i), bool)
    for r in range(run):
        fresh &= (leaves[i, r] != leaves[j, r]) | (leaves[i, r] == 0)
    return fresh


def _promising_pairs(table: pa.Table, runs: int) -> tuple[np.ndarray, np.ndarray]:
    leaves = np.array(table.column("leaves").combine_chunks().flatten()).reshape(-1, runs)
    tokens = np.frombuffer(b"".join(table.column("tokens").to_pylist()), np.uint32).reshape(-1, TOKENS)
    i, j = pairs(table)
    fresh = _first_shared(leaves, table.column("run")[0].as_py(), i, j)
    i, j = i[fresh], j[fresh]
    equal = np.zeros(len(i), np.int16)
    for k in range(TOKENS):
        equal += tokens[i, k] == tokens[j, k]
    near = equal >= _PROMISING
    return i[near], j[near]


def _common(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Size of the intersection of each pair of sets."""
    if len(i) <= 4:
        return np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(i.tolist(), j.tolist())], np.int64)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, gram, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    column = np.cumsum(times > 1) - 1
    keep = times[gram] > 1
    row, gram = row[keep], column[gram[keep]]
    order = np.argsort(gram, kind="stable")
    row, gram = row[order], gram[order]
    total = np.zeros((len(sets), len(sets)), np.float32)
    for low in range(0, int(gram[-1]) + 1 if len(gram) else 0, 4096):
        a, b = np.searchsorted(gram, (low, low + 4096))
        held = np.zeros((len(sets), 4096), np.float32)
        held[row[a:b], gram[a:b] - low] = 1
        total += held @ held.T
    return total[i, j].astype(np.int64)


def _classified(docs: DataFrame, id_col: str, text_col: str, n: int, similarity: float, runs: int, limit: int) -> DataFrame:
    """(_id, _th, n, class_id, class_th, n_links) of every row."""
    base = docs.select(*doc_key(id_col, text_col), F.col(text_col).alias("_text"))
    embedded = materialize(base.mapInArrow(_embedder(n), "_id long, _th long, n long, low long, high long, tokens binary"), "embedded")
    classes = materialize(
        embedded.where("n > 0").groupBy("low", "high").agg(
            F.min(F.struct("_id", "_th")).alias("rep"), F.count("*").alias("members"), F.first("tokens").alias("tokens"))
        .select("low", "high", "rep._id", "rep._th", "members", "tokens", F.monotonically_increasing_id().alias("node")), "classes")
    keys = ", ".join(f"k{d} long" for d in range(DEPTH))
    walked = classes.select("node", "tokens").mapInArrow(_paths(runs, DEPTH), f"run int, node long, {keys}")
    leaves = materialize(_leaves(walked, limit, DEPTH), "leaves")
    # all leaves of a class side by side: 0 where it is alone
    own = leaves.groupBy("node").pivot("run", list(range(runs))).agg(F.first("bucket"))
    own = own.select("node", F.array(*(F.coalesce(F.col(str(r)), F.lit(0)) for r in range(runs))).alias("leaves"))
    met = classes.select("node", "members", "_id", "_th", "tokens").join(own, "node")
    met = materialize(met, "met")
    spread = dealt(leaves.join(met.select("node", "leaves", "tokens"), "node"), limit)

    def promising(table: pa.Table) -> pa.Table | None:
        i, j = _promising_pairs(table, runs)
        some = np.union1d(i, j)
        return table.select(["run", "node", "bucket", "left", "right", "side"]).take(pa.array(some)) if len(some) else None

    wanted = materialize(by_block(spread.drop("size"), promising, "run int, node long, bucket long, left long, right long, side long"), "wanted")
    needed = wanted.select("node").distinct().join(met.select("node", "_id", "_th"), "node")
    texts = base.join(needed, ["_id", "_th"]).dropDuplicates(["node"]).select("node", "_text")
    brought = wanted.join(met.select("node", "members", "leaves", "tokens"), "node").join(texts, "node")

    def verify(table: pa.Table) -> pa.Table | None:
        i, j = _promising_pairs(table, runs)
        sets: list[np.ndarray] = []
        for _, rows in text_slices(table.column("_text")):
            doc, grams = shingles(Words(rows), n)
            sets += np.split(grams, np.searchsorted(doc, np.arange(1, len(rows))))
        common = _common(sets, i, j)
        size = np.array([len(s) for s in sets])
        near = common >= similarity * (size[i] + size[j] - common) - 1e-9
        return link_rows(table.column("node").to_numpy(), table.column("members").to_numpy().astype(float), i[near], j[near])

    linked = materialize(by_block(brought, verify, LINKS), "linked")
    found = linked.groupBy("node").agg(F.sum("links").alias("links"))
    parts = components(linked.select(F.col("node").alias("a"), F.col("other").alias("b")))
    named = classes.select("node", "low", "high", "_id", "_th", "members").join(parts, "node", "left").join(found, "node", "left")
    named = named.withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min(F.struct("_id", "_th")).alias("least"))
    told = materialize(named.join(least, "component").select(
        "low", "high", F.col("least._id").alias("class_id"), F.col("least._th").alias("class_th"),
        (F.coalesce("links", F.lit(0)) + F.col("members") - 1).alias("n_links")), "told")
    return embedded.select("_id", "_th", "n", "low", "high").join(told, ["low", "high"], "left").select(
        "_id", "_th", "n", F.coalesce("class_id", "_id").alias("class_id"), F.coalesce("class_th", "_th").alias("class_th"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = WORDS,
                 similarity: float = SIMILARITY, runs: int = RUNS, limit: int = LEAF) -> DataFrame:
    """(id, class_id, n_links) of every row: links are other documents at or over
    ``similarity``; the class id is the smallest id reachable by links."""
    rows = _classified(docs, id_col, text_col, n, similarity, runs, limit)
    null = lambda c: F.when(c == NULL_ID, None).otherwise(c)
    return rows.select(null(F.col("_id")).alias(id_col), null(F.col("class_id")).alias("class_id"), "n_links")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = WORDS,
             similarity: float = SIMILARITY, runs: int = RUNS, limit: int = LEAF) -> DataFrame:
    """``docs`` with the first document of each class only; those without words all stay."""
    rows = _classified(docs, id_col, text_col, n, similarity, runs, limit)
    stay = rows.where((F.col("n") == 0) | ((F.col("_id") == F.col("class_id")) & (F.col("_th") == F.col("class_th"))))
    stay = materialize(stay.select("_id", "_th", (F.col("n") > 0).alias("_once")).distinct(), "stay")
    columns = docs.columns
    keyed = docs.select(*(F.col(c).alias(f"_in_{i}") for i, c in enumerate(columns)), *doc_key(id_col, text_col))
    kept = keyed.join(stay, ["_id", "_th"])
    kept = kept.where("_once").dropDuplicates(["_id", "_th"]).unionByName(kept.where("NOT _once"))
    return kept.select(*(F.col(f"_in_{i}").alias(c) for i, c in enumerate(columns)))
