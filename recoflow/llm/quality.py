"""Quality rules: base rules, then a hashed n-gram log-likelihood ratio.

Two multinomials over hashed byte n-grams are counted: one over the
trusted documents (labelled quality 1), one over the whole raw corpus. A
document's score is its mean log ratio of the two per n-gram; documents
under a fixed threshold are rejected. The threshold is read off the
labelled documents' score histogram: the one that rejects most of those
labelled 0 while ``min_keep`` of those labelled 1 stay.

Model and threshold are learned from every labelled row: texts and labels are joined
by id for the counts, and only (id, score bin) rows for the threshold.

Cases: an empty table gives no rows; null text has no words and fails the base rules. Labels with a null
id or quality are ignored; of repeated labels the highest counts. Without
labels of both kinds only the base rules reject. Repeated documents are
judged each. Only id and text are read, so further columns cannot clash;
``keep_documents`` passes all columns on unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_slices
from .textscan import Words, byte_runs, mix, segment_sums

BUCKETS = 1 << 16
NGRAM = 3
_SYMBOLS = np.zeros(256, np.int64)
_SYMBOLS[list(b"#*$%&|<>")] = 1
_BINS_PER_UNIT = 1000
_FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_UNIT = float(1 << 32)    # log ratios are summed as whole multiples of 1 / _UNIT


class Model(NamedTuple):
    log_ratio: np.ndarray  # float64, BUCKETS long
    threshold: float


def ngram_buckets(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of each byte n-gram, first and end n-gram of each row)."""
    data = words.data.astype(np.uint32)
    size = max(0, len(data) - NGRAM + 1)
    code = np.zeros(size, np.uint32)
    for i in range(NGRAM):
        code = (code << np.uint32(8)) | data[i: i + size]
    buckets = (code * np.uint32(2654435761)) >> np.uint32(16)
    first = np.minimum(words.bounds[:-1], size)
    return buckets, first, np.clip(words.bounds[1:] - NGRAM + 1, first, size)


def base_features(words: Words) -> dict[str, np.ndarray]:
    """The five base columns of every row of a slice."""
    data, n = words.data, words.n_docs
    starts, ends = words.bounds[:-1], words.bounds[1:]
    space = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
    letters = (~space & ((data & 0xC0) != 0x80)).astype(np.int64)
    newline = np.flatnonzero(data == 0x0A)
    line_start = np.unique(np.concatenate([starts[starts < ends], newline + 1]))
    line_start = line_start[line_start < len(data)]
    line_doc = np.searchsorted(words.bounds, line_start, side="right") - 1
    stop = np.searchsorted(newline, line_start)
    line_end = np.append(newline, len(data))[stop]
    line_end = np.minimum(line_end, words.bounds[line_doc + 1])
    filled = np.searchsorted(words.start, line_end) > np.searchsorted(words.start, line_start)
    line_start, line_end, line_doc = line_start[filled], line_end[filled], line_doc[filled]
    key = mix(byte_runs(data, line_start, line_end) ^ mix(line_doc.astype(np.uint64), 5), 6)
    _, distinct = np.unique(key, return_index=True)
    dup_lines = np.bincount(line_doc, minlength=n) - np.bincount(line_doc[distinct], minlength=n)
    at, window = words.windows(words.hashes(), 5)
    key = mix(window ^ mix(words.doc[at].astype(np.uint64), 7), 8)
    _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
    repeated = words.covered(at[count[inverse] > 1], 5)
    return {
        "n_words": words.count,
        "word_chars": segment_sums(letters, starts, ends),
        "n_symbols": segment_sums(_SYMBOLS[data], starts, ends),
        "n_dup_lines": dup_lines,
        "n_repeat_words": np.bincount(words.doc[repeated], minlength=n),
    }


def base_failed(features: dict[str, np.ndarray]) -> np.ndarray:
    return (features["n_words"] < 10) | (100 * features["n_repeat_words"] > 20 * features["n_words"])


def mean_log_ratio(words: Words, log_ratio: np.ndarray) -> np.ndarray:
    """Mean per row; the sums are of whole numbers, so a row's score does not depend on its neighbours."""
    buckets, first, end = ngram_buckets(words)
    whole = np.rint(log_ratio * _UNIT).astype(np.int64)
    return segment_sums(whole[buckets], first, end) / _UNIT / np.maximum(1, end - first)


def _labelled(rows: DataFrame, rated: DataFrame) -> DataFrame:
    """``rows`` with q, the label of their id; rows without an id have none, and are not dealt to one task."""
    keyed = rows.withColumn("_key", F.coalesce("id", F.xxhash64("text"))).withColumn("_lacks", F.col("id").isNull())
    # merged whatever the size, so that the work a row does not change with it
    return keyed.join(rated.select(F.col("id").alias("_key"), "q", F.lit(False).alias("_lacks")).hint("merge"), ["_key", "_lacks"], "left")


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_keep: float = 0.995) -> Model:
    """Count both multinomials and set the threshold."""
    spark = docs.sparkSession
    rated = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    rated = rated.groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max("quality").alias("q"))
    good, bad = rated.agg(F.count_if(F.col("q") == 1), F.count_if(F.col("q") == 0)).first()
    if not good or not bad:
        return Model(np.zeros(BUCKETS), -np.inf)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw = np.zeros(BUCKETS, np.int64)
        target = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            trusted = batch.column(0).fill_null(False).to_numpy(zero_copy_only=False)
            for at, part in text_slices(batch.column(1)):
                words = Words(part)
                buckets, first, end = ngram_buckets(words)
                step = np.zeros(len(buckets) + 1, np.int64)
                inside = np.zeros(len(buckets) + 1, np.int64)
                np.add.at(inside, first, 1)
                np.add.at(inside, end, -1)
                mine = trusted[at: at + len(part)]
                np.add.at(step, first[mine], 1)
                np.add.at(step, end[mine], -1)
                raw += np.bincount(buckets[np.cumsum(inside[:-1]) > 0], minlength=BUCKETS)
                target += np.bincount(buckets[np.cumsum(step[:-1]) > 0], minlength=BUCKETS)
        seen = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(raw[seen]), pa.array(target[seen])],
                                         names=["bucket", "raw", "target"])

    counts = _labelled(texts, rated).select((F.col("q") == 1).alias("trusted"), "text").mapInArrow(
        tally, "bucket int, raw long, target long").groupBy("bucket").agg(
        F.sum("raw").alias("raw"), F.sum("target").alias("target")).toPandas()  # BUCKETS rows at most
    raw, target = np.ones(BUCKETS), np.ones(BUCKETS)
    raw[counts.bucket] += counts.raw
    target[counts.bucket] += counts.target
    log_ratio = np.log(target / target.sum()) - np.log(raw / raw.sum())
    model = spark.sparkContext.broadcast(log_ratio)

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, part in text_slices(batch.column(1)):
                words = Words(part)
                bins = np.floor(mean_log_ratio(words, model.value) * _BINS_PER_UNIT)
                passed = pa.array(~base_failed(base_features(words)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(part)).filter(passed), pa.array(bins.astype(np.int64)).filter(passed)], names=["id", "bin"])

    rows = texts.where(F.col("id").isNotNull()).mapInArrow(rate, "id long, bin long").groupBy("id", "bin").count()
    bins = rows.join(rated.where("q in (0, 1)").hint("merge"), "id").groupBy("q", "bin").agg(F.sum("count").alias("count")).toPandas()
    return Model(log_ratio, pick_threshold(bins, min_keep))


def pick_threshold(bins, min_keep: float) -> float:
    """The highest bin edge that keeps ``min_keep`` of quality 1, if it rejects any of quality 0."""
    bins = bins.sort_values("bin")
    good = bins[bins.q == 1]
    bad = bins[bins.q == 0]
    total = good["count"].sum()
    if not total:
        return -np.inf
    lost = good["count"].cumsum() - good["count"]  # rejected when the edge is this bin
    edge = int(good.bin[lost <= (1 - min_keep) * total].max())
    return edge / _BINS_PER_UNIT if (bad.bin < edge).any() else -np.inf


def judge_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the base columns, base_failed, kept and score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, " + ", ".join(f"{c} long" for c in _FEATURES) + ", base_failed boolean, kept boolean, score double"

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        log_ratio, threshold = shared.value
        for batch in batches:
            for at, part in text_slices(batch.column(1)):
                words = Words(part)
                found = base_features(words)
                failed, score = base_failed(found), mean_log_ratio(words, log_ratio)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(part)), *(pa.array(found[c].astype(np.int64)) for c in _FEATURES),
                     pa.array(failed), pa.array(~failed & (score >= threshold)), pa.array(score)],
                    names=[id_col, *_FEATURES, "base_failed", "kept", "score"])

    return docs.select(id_col, F.col(text_col).alias("text")).mapInArrow(judge, schema)


def keep_documents(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The documents that pass, with all their columns; one narrow pass."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    index = docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        log_ratio, threshold = shared.value
        for batch in batches:
            for at, part in text_slices(batch.column(index)):
                words = Words(part)
                passed = ~base_failed(base_features(words)) & (mean_log_ratio(words, log_ratio) >= threshold)
                yield batch.slice(at, len(part)).filter(pa.array(passed))

    return docs.mapInArrow(keep, docs.schema)
