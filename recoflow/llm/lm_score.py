"""Language-model scoring by deleted interpolation of n-gram estimates.

A bigram model: P(w | v) mixes c(v, w) / c(v), c(w) / N and 1 / (V + 1).
The three weights depend on how frequent the context is (one set for each
power of two of c(v)) and are learned by expectation-maximisation on
deleted counts: every training bigram is judged by the counts of all the
training text but itself.

The corpus is first cut into blocks of documents, written once as word
numbers. Each block sends every distinct word and bigram it holds once,
with its training count, to the hash bucket of that item; a bucket sums
and answers each block in the order it asked. So what is shuffled follows
the distinct items of blocks, a frequent word or pair costs one entry a
block, and no table of counts is ever held in one place. The number of
buckets grows with the corpus (``BUCKET_ITEMS`` entries each).

Cases: null text is empty and is scored as one end token. A null id counts
as the empty text for the choice of training rows. Repeated rows are
scored (and learned) each. An empty table gives no rows; without training
rows every token has probability 1. Only id and text are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize, text_slices
from .textscan import Words, mix

FOLDS = 7
HELD_OUT = 2
BLOCK_BYTES = 3_000_000
BUCKET_ITEMS = 1 << 19
ROUNDS = 60
#: Stand for the end of a text, and for its beginning as a context.
_END = np.uint64(0x5851F42D4C957F2C)
_BEGIN = np.uint64(0x14057B7EF767814E)
_BLOCK_SCHEMA = "block long, doc_ids array<long>, train binary, sizes binary, words binary, tokens binary"


def held_out(doc_ids: list[int | None]) -> np.ndarray:
    return np.array([zlib.crc32(b"" if i is None else str(i).encode()) % FOLDS == HELD_OUT for i in doc_ids], bool)


def _tokens(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(tokens of each row, hashes of all tokens): the words of a row, then its end."""
    sizes = words.count + 1
    hashes = np.full(int(sizes.sum()), _END)
    inner = np.ones(len(hashes), bool)
    inner[np.cumsum(sizes) - 1] = False
    hashes[inner] = words.hashes() & ~np.uint64(1)
    return sizes, hashes


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task, made = TaskContext.get().partitionId() << 32, 0
    for batch in batches:
        for at, rows in text_slices(batch.column(1), BLOCK_BYTES):
            ids = batch.column(0).slice(at, len(rows)).to_pylist()
            parts = [_tokens(Words(part, lower=True)) for _, part in text_slices(rows)]
            sizes, hashes = (np.concatenate(x) for x in zip(*parts))
            known, tokens = np.unique(hashes, return_inverse=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([task + made]), pa.array([ids], pa.list_(pa.int64())),
                 *(pa.array([x.tobytes()], pa.binary()) for x in (~held_out(ids), sizes.astype("<i8"), known, tokens.astype("<i4")))],
                names=["block", "doc_ids", "train", "sizes", "words", "tokens"])
            made += 1


class Block:
    """A block's tokens, and its distinct items: words first, then bigrams."""

    def __init__(self, row: dict):
        self.doc_ids = row["doc_ids"]
        self.sizes = np.frombuffer(row["sizes"], "<i8")
        self.train = np.frombuffer(row["train"], bool)
        self.words = np.frombuffer(row["words"], np.uint64)
        self.tokens = np.frombuffer(row["tokens"], "<i4").astype(np.int64)
        self.first = np.cumsum(self.sizes) - self.sizes
        context = np.empty(len(self.tokens), np.int64)
        context[1:] = self.tokens[:-1]
        context[self.first] = len(self.words)
        self.context = context
        pair = context * (len(self.words) + 1) + self.tokens
        self.pairs, self.pair_of = np.unique(pair, return_inverse=True)
        self.learned = np.repeat(self.train, self.sizes)

    def items(self) -> tuple[np.ndarray, np.ndarray]:
        """(hash, training count); the last bit tells words from bigrams."""
        known = np.append(self.words, _BEGIN)
        a, b = known[self.pairs // len(known)], known[self.pairs % len(known)]
        pair = mix(mix(a, 3) ^ (b * np.uint64(0x9E3779B97F4A7C15)), 4) | np.uint64(1)
        count = [np.bincount(x[self.learned], minlength=n) for x, n in ((self.tokens, len(self.words)), (self.pair_of, len(self.pairs)))]
        return np.concatenate([self.words, pair]), np.concatenate(count)


def _bucket_of(items: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(items, 9) % np.uint64(buckets)).astype(np.int64)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _asker(buckets: int):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            items, counts = Block(row).items()
            bucket = _bucket_of(items, buckets)
            order = np.lexsort((items, bucket))
            edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
            full = np.flatnonzero(np.diff(edges))
            own = [order[edges[b]: edges[b + 1]] for b in full]
            yield pa.RecordBatch.from_arrays(
                [pa.array(full), pa.array([row["block"]] * len(full), pa.int64()),
                 pa.array([_planes(np.diff(items[o], prepend=np.uint64(0))) for o in own], pa.binary()),
                 pa.array([counts[o].astype("<u4").tobytes() for o in own], pa.binary())], names=["bucket", "block", "items", "counts"])
    return ask


def _planes(values: np.ndarray) -> bytes:
    """Bytes of equal weight side by side: the high ones of sorted differences are few and compress."""
    return values.view(np.uint8).reshape(-1, 8).T.tobytes()


def _from_planes(raw: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(raw, np.uint8).reshape(8, -1).T.copy().view(np.uint64).ravel(), dtype=np.uint64)


def _answer(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    asked = [_from_planes(x) for x in table.column("items").to_pylist()]
    counts = np.concatenate([np.frombuffer(x, "<u4") for x in table.column("counts").to_pylist()])
    items = np.concatenate(asked)
    distinct, inverse = np.unique(items, return_inverse=True)
    total = np.bincount(inverse, weights=counts, minlength=len(distinct)).astype(np.int64)
    types = int(((distinct & np.uint64(1) == 0) & (total > 0)).sum())
    back = np.split(total[inverse].astype("<i8"), np.cumsum([len(x) for x in asked])[:-1])
    return pa.table({"block": table.column("block"), "bucket": table.column("bucket"),
                     "totals": pa.array([_planes(x) for x in back], pa.binary()),
                     "types": pa.array([types] + [0] * (len(back) - 1), pa.int64())})


_JOINED = "doc_ids array<long>, train binary, sizes binary, tokens binary, unigram binary, bigram binary"


def _joiner(buckets: int):
    def join(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        block = Block(row)
        items, _ = block.items()
        bucket = _bucket_of(items, buckets)
        order = np.lexsort((items, bucket))
        right = right.sort_by("bucket")
        answers = np.concatenate([np.frombuffer(x, np.uint8).reshape(8, -1).T.copy().view("<i8").ravel() for x in right.column("totals").to_pylist()])
        total = np.empty(len(items), np.int64)
        total[order] = answers
        unigram, bigram = total[: len(block.words)], total[len(block.words):][block.pair_of]
        return pa.table({c: [row[c]] for c in ("doc_ids", "train", "sizes", "tokens")}
                        | {"unigram": pa.array([_planes(unigram)], pa.binary()), "bigram": pa.array([_planes(bigram)], pa.binary())},
                        schema=pa.schema([("doc_ids", pa.list_(pa.int64())), *((c, pa.binary()) for c in ("train", "sizes", "tokens", "unigram", "bigram"))]))
    return join


def _counts(row: dict, starts_total: int) -> tuple[np.ndarray, ...]:
    """(rows' sizes, their first tokens, c(w), c(v), c(v, w)) of every token."""
    whole = [np.frombuffer(row[c], np.uint8).reshape(8, -1).T.copy().view("<i8").ravel() for c in ("unigram", "bigram")]
    sizes, tokens = np.frombuffer(row["sizes"], "<i8"), np.frombuffer(row["tokens"], "<i4")
    word = whole[0][tokens]
    first = np.cumsum(sizes) - sizes
    context = np.empty(len(word), np.int64)
    context[1:] = word[:-1]
    context[first] = starts_total
    return sizes, first, word, context, whole[1]


def context_class(count: np.ndarray) -> np.ndarray:
    """0 for unseen contexts, else 1 + floor(log2(count))."""
    return np.where(count > 0, np.frexp(count.astype(float))[1], 0)


def learn_weights(cells, uniform: float, rounds: int = ROUNDS) -> np.ndarray:
    """EM for each class of contexts: weights (bigram, unigram, uniform), 65 x 3."""
    weights = np.tile([0.0, 0.5, 0.5], (65, 1))
    for kind, own in cells.groupby("kind"):
        n = own.n.to_numpy(float)
        p = np.stack([own.p2 / own.n, own.p1 / own.n, np.full(len(own), uniform)], axis=1)
        mixed = np.full(3, 1 / 3)
        for _ in range(rounds):
            share = p * mixed
            share /= np.maximum(share.sum(axis=1, keepdims=True), 1e-300)
            mixed = (share * n[:, None]).sum(axis=0) / n.sum()
        weights[int(kind)] = mixed
    return weights


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    blocks = materialize(texts.mapInArrow(_blocks, _BLOCK_SCHEMA), "blocks")
    held = blocks.agg(F.sum(F.length("tokens") / 4 + F.length("words") / 8)).first()[0] or 0
    buckets = max(1, int(-(-held // BUCKET_ITEMS)))
    asked = blocks.mapInArrow(_asker(buckets), "bucket long, block long, items binary, counts binary")
    answers = materialize(asked.groupBy("bucket").applyInArrow(_answer, "block long, bucket long, totals binary, types long"), "answers", batch_rows=2)
    v = answers.agg(F.sum("types")).first()[0] or 0
    joined = materialize(blocks.groupBy("block").cogroup(answers.select("block", "bucket", "totals").groupBy("block"))
                         .applyInArrow(_joiner(buckets), _JOINED), "counted")
    discard(answers)
    discard(blocks)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            train, sizes = np.frombuffer(row["train"], bool), np.frombuffer(row["sizes"], "<i8")
            yield pa.RecordBatch.from_arrays([pa.array([int(sizes[train].sum())]), pa.array([int(train.sum())])], names=["n", "texts"])

    told = joined.select("train", "sizes").mapInArrow(sums, "n long, texts long").agg(F.sum("n"), F.sum("texts")).first()
    n, n_texts = told[0] or 0, told[1] or 0
    uniform = 1 / (v + 1)

    def deleted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            sizes, _, word, context, pair = _counts(row, n_texts)
            own = np.repeat(np.frombuffer(row["train"], bool), sizes)
            word, context, pair = word[own], context[own], pair[own]
            p2 = np.where(context > 1, (pair - 1) / np.maximum(context - 1, 1), 0.0)
            p1 = (word - 1) / max(n - 1, 1)
            halves = [np.where(p > 0, np.round(-2 * np.log2(np.maximum(p, 1e-30))), 255).astype(np.int64) for p in (p2, p1)]
            cell, inverse, times = np.unique((context_class(context) << 16) | (halves[0] << 8) | halves[1], return_inverse=True, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cell), pa.array(times), *(pa.array(np.bincount(inverse, weights=p, minlength=len(cell))) for p in (p2, p1))],
                names=["cell", "n", "p2", "p1"])

    # at most 65 x 256 x 256 cells, in fact some ten thousand, however large the corpus
    cells = materialize(joined.drop("doc_ids").mapInArrow(deleted, "cell long, n long, p2 double, p1 double"), "cells", batch_rows=1).groupBy("cell").agg(
        *(F.sum(c).alias(c) for c in ("n", "p2", "p1"))).orderBy("cell").toPandas()
    cells["kind"] = cells.cell.to_numpy(np.int64) >> 16
    weights = spark.sparkContext.broadcast(learn_weights(cells, uniform))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixed = weights.value
        for row in _rows(batches):
            sizes, first, word, context, pair = _counts(row, n_texts)
            own = mixed[context_class(context)]
            p = own[:, 0] * (pair / np.maximum(context, 1)) + own[:, 1] * (word / max(n, 1)) + own[:, 2] * uniform
            if not n:
                p = np.ones(len(p))
            plain = np.log10((word + 1) / (n + v + 1))
            ids = row["doc_ids"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(held_out(ids)), pa.array(sizes),
                 pa.array(np.add.reduceat((word > 0).astype(np.int64), first)), pa.array(np.full(len(ids), n, np.int64)),
                 pa.array(np.add.reduceat(plain, first)), pa.array(np.add.reduceat(np.log10(p), first))],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return materialize(joined.mapInArrow(score, schema), "scores", batch_rows=1)
