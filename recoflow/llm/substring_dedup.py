"""Substring dedup: remove windows of words that occur earlier in the corpus.

Count-min prefilter. Every window of ``window`` words holds one selected
anchor, the smallest hash among its runs of ``anchor`` words, so equal
windows have equal anchors and a window occurs at most as often as its
anchor is selected. Tasks count selected anchors in partition sketches;
merged, these overestimate the count of every window. A second pass
fingerprints only the windows whose estimate is two or more and groups
those exactly (128-bit fingerprints), so no repeated window is lost.
Repeats inside one document are settled where the document is read;
across documents a window goes to the smallest id. Each window counts
once per document and task before any shuffle, and a window that a third
of all documents hold is a skewed join that adaptive execution splits.

Cases: an empty table gives no rows; null text has no words. Null ids are the smallest. Rows with the
same id and text are one document (each gets its result); rows with one id
and different texts are different documents of which neither is earlier
(told apart by 32 bits of a hash of the text).
Documents shorter than a window stay whole. Only id and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, doc_key, materialize, text_slices
from .textscan import Words, mix

WINDOW = 20
ANCHOR = 8
SKETCH_CELLS = 1 << 27   # cells of a row of the sketch; two rows of one bit each are broadcast (32 MB)
_BLOCK = 1 << 20         # cells in one merged part of a row
_HELD = 1 << 22          # anchors a task holds before it emits a partition sketch
_MERGED = 64             # partition sketches that one task merges


def window_anchors(words: Words, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word of every window, its anchor's position, hash of the anchor)."""
    hashes = words.hashes()
    first, runs = words.windows(hashes, anchor)
    at_run = np.full(len(hashes) + 1, -1, np.int64)
    at_run[first] = np.arange(len(first))
    starts = words.window_starts(window)
    best_at = at_run[starts]
    best = runs[best_at]
    for step in range(1, window - anchor + 1):
        at = at_run[starts + step]
        less = runs[at] < best
        best = np.where(less, runs[at], best)
        best_at = np.where(less, at, best_at)
    return starts, first[best_at] if len(starts) else starts, best


def _cells(anchor: np.ndarray, row: int, cells: int) -> np.ndarray:
    return (mix(anchor, 11 + row) % np.uint64(cells)).astype(np.int64)


def sketch(texts: DataFrame, window: int, anchor: int, cells: int) -> list[np.ndarray]:
    """Bits of the cells counted twice or more, one array per row of the sketch."""
    blocks = -(-cells // _BLOCK)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        task = TaskContext.get().partitionId()

        def emit() -> pa.RecordBatch:
            found = np.concatenate(held) if held else np.zeros(0, np.uint64)
            held.clear()
            part, once, twice = [], [], []
            for row in (0, 1):
                cell, times = np.unique(_cells(found, row, cells), return_counts=True)
                edges = np.searchsorted(cell, np.arange(blocks + 1) * _BLOCK)
                for b in np.flatnonzero(np.diff(edges)).tolist():
                    own, often = cell[edges[b]: edges[b + 1]] - b * _BLOCK, times[edges[b]: edges[b + 1]] > 1
                    part.append(row * blocks + b)
                    once.append(own[~often].astype("<u4").tobytes())
                    twice.append(own[often].astype("<u4").tobytes())
            return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array([task // _MERGED] * len(part), pa.int32()),
                                               pa.array(once, pa.binary()), pa.array(twice, pa.binary())],
                                              names=["part", "band", "once", "twice"])

        for batch in batches:
            for _, rows in text_slices(batch.column(0)):
                _, position, anchors = window_anchors(Words(rows), window, anchor)
                _, pick = np.unique(position, return_index=True)
                held.append(anchors[pick])
                if sum(map(len, held)) >= _HELD:
                    yield emit()
        yield emit()

    def merge(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        times = np.zeros(_BLOCK, np.uint8)
        for batch in batches:
            for once, twice in zip(batch.column("once").to_pylist(), batch.column("twice").to_pylist()):
                seen = np.frombuffer(once, "<u4")
                times[seen] = np.minimum(times[seen] + 1, 2)
                times[np.frombuffer(twice, "<u4")] = 2
        yield pa.RecordBatch.from_arrays(
            [pa.array([key[0].as_py()], pa.int32()), pa.array([key[1].as_py() // _MERGED], pa.int32()),
             pa.array([np.flatnonzero(times == 1).astype("<u4").tobytes()], pa.binary()),
             pa.array([np.flatnonzero(times == 2).astype("<u4").tobytes()], pa.binary())], names=["part", "band", "once", "twice"])

    schema = "part int, band int, once binary, twice binary"
    parts = materialize(texts.mapInArrow(count, schema), "sketch")
    most = parts.agg(F.max("band")).first()[0] or 0
    while True:  # a tree: no task merges more than a band's sketches
        merged = materialize(parts.groupBy("part", "band").applyInArrow(merge, schema), "sketch")
        discard(parts)
        parts = merged
        if not most:
            break
        most //= _MERGED
    bits = [np.zeros(blocks * _BLOCK // 8, np.uint8) for _ in (0, 1)]
    for row in parts.select("part", "twice").toLocalIterator():  # as many rows as the sketch has blocks
        own = np.zeros(_BLOCK, np.uint8)
        own[np.frombuffer(row.twice, "<u4")] = 1
        at = row.part % blocks * (_BLOCK // 8)
        bits[row.part // blocks][at: at + _BLOCK // 8] = np.packbits(own, bitorder="little")
    discard(parts)
    return bits


def _estimated_repeated(anchors: np.ndarray, bits: list[np.ndarray], cells: int) -> np.ndarray:
    keep = np.ones(len(anchors), bool)
    for row in (0, 1):
        cell = _cells(anchors, row, cells)
        keep &= (bits[row][cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 == 1
    return keep


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                     anchor: int = ANCHOR, cells: int = SKETCH_CELLS, with_text: bool = True) -> DataFrame:
    """Per document: id, n_words, n_removed, kept_sha256 and, on demand, ``kept`` (the text that stays)."""
    spark = docs.sparkSession
    base = docs.select(*doc_key(id_col, text_col), F.col(id_col).alias("_doc"), F.col(text_col).alias("_text"))
    base = base.withColumn("_th", F.shiftright("_th", 32).cast("int"))  # only tells documents of one id apart
    bits = spark.sparkContext.broadcast(sketch(base.select("_text"), window, anchor, cells))

    def fingerprint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hashes = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for at, rows in text_slices(batch.column(2)):
                words = Words(rows)
                starts, _, anchors = window_anchors(words, window, anchor)
                keep = _estimated_repeated(anchors, bits.value, cells)
                starts = starts[keep]
                low, high = (words.windows(words.hashes(f), window, f) for f in (0, 1))
                where = np.searchsorted(low[0], starts)
                low, high, doc = low[1][where], high[1][where], words.doc[starts]
                # a window is sent once a document, at its first start; its later starts are removed here
                order = np.lexsort((starts, high, low, doc))
                same = np.zeros(len(order), bool)
                a, b = order[1:], order[:-1]
                same[1:] = (doc[a] == doc[b]) & (low[a] == low[b]) & (high[a] == high[b])
                again = np.zeros(len(order), bool)
                again[order] = same
                low, high = (np.where(again, np.uint64(0), x) for x in (low, high))  # settled: its fingerprint is of no more use
                yield pa.RecordBatch.from_arrays(
                    [pa.array(low.view(np.int64)), pa.array(high.view(np.int64)), pa.array(ids[at + doc]), pa.array(hashes[at + doc]),
                     pa.array((starts - words.first[doc]).astype(np.int32)), pa.array(again)],
                    names=["low", "high", "_id", "_th", "start", "again"])

    found = materialize(base.select("_id", "_th", "_text").mapInArrow(
        fingerprint, "low long, high long, _id long, _th int, start int, again boolean"), "windows")
    # the text hash and the start travel as one number: windows make up most of what is shuffled
    once = found.where("NOT again").select("low", "high", "_id", (F.shiftleft(F.col("_th").cast("long"), 32) + F.col("start")).alias("place"))
    groups = once.groupBy("low", "high").agg(F.min("_id").alias("first_id"), F.max("_id").alias("last_id"))
    first = materialize(groups.where("first_id < last_id").select("low", "high", "first_id"), "first")
    later = once.join(first, ["low", "high"]).where(F.col("_id") > F.col("first_id")).select(
        "_id", F.shiftright("place", 32).cast("int").alias("_th"), F.col("place").bitwiseAND(F.lit(0x7FFFFFFF)).cast("int").alias("start"))
    starts = materialize(later.unionByName(found.where("again").select("_id", "_th", "start"))
                         .groupBy("_id", "_th").agg(F.collect_list("start").alias("starts")), "starts")
    discard(found)
    discard(first)

    names = [id_col, "n_words", "n_removed", "kept_sha256", *(["kept"] if with_text else [])]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, rows in text_slices(batch.column(1)):
                words = Words(rows)
                raw = words.data.tobytes()
                own = batch.slice(at, len(rows))
                removed = own.column(2).to_pylist()
                kept = []
                for i, drop in enumerate(removed):
                    a, b = words.first[i], words.first[i + 1]
                    stay = np.ones(b - a, bool)
                    if drop:
                        edge = np.zeros(b - a + 1, np.int64)
                        drop = np.unique(np.array(drop))
                        edge[drop] += 1
                        edge[drop + window] -= 1
                        stay = np.cumsum(edge[:-1]) == 0
                    kept.append((int(b - a), int(b - a - stay.sum()),
                                 b" ".join([raw[s:e] for s, e in zip(words.start[a:b][stay].tolist(), words.end[a:b][stay].tolist())])))
                yield pa.RecordBatch.from_arrays(
                    [own.column(0), pa.array([k[0] for k in kept], pa.int64()), pa.array([k[1] for k in kept], pa.int64()),
                     pa.array([hashlib.sha256(k[2]).hexdigest() for k in kept], pa.string()),
                     *([pa.array([k[2].decode() for k in kept], pa.string())] if with_text else [])], names=names)

    joined = base.join(starts, ["_id", "_th"], "left").select("_doc", "_text", "starts")
    kind = docs.schema[id_col].dataType.simpleString()
    return joined.mapInArrow(cut, f"`{id_col}` {kind}, n_words long, n_removed long, kept_sha256 string" + (", kept string" if with_text else ""))
