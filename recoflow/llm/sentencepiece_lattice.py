"""SentencePiece encoding and decoding over a relational lattice.

Texts are cut into units no piece reaches across: at spaces, and between
characters that stand side by side in no piece. Each distinct unit is
encoded once: its substrings up to the longest piece are exploded and
equi-joined to the piece table, the resulting edges are grouped by unit,
and a higher-order ``aggregate`` folds them. For a unigram model the fold
is Viterbi's (best score sum up to each place). For a BPE model the best
score sum is not what the model means; there the fold merges, step by
step, the best-scored edge over two neighbouring symbols, on the same
edges. Either gives the ids of the ``sentencepiece`` library.

Texts are read once: each becomes numbers of units in the list of its
chunk, some hundred thousand distinct words of one task's documents. The
ids come to the lists: the ``HEAD_UNITS`` units in most chunks (a fixed
bound) are broadcast, all others are joined by unit and dealt by chunk.
The numbered documents lie in buckets by chunk, so they are not shuffled.
Units over ``LONGEST`` characters, too long for the fold's bit set, are
encoded by the same rules in a function.

Cases: an empty table gives no rows; null text has no ids (null); an empty one an empty list. Rows with
the same id and text are one document, each gets its ids; null ids are an
id of their own. U+2581 counts as a space, as in the library. Only id and
text are read. The model file's normaliser must be the identity.
"""

from __future__ import annotations

import heapq
import re
from array import array
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, materialize

HEAD_UNITS = 200_000
HELD_WORDS = 250_000
LONGEST = 60
SPACE = "▁"
_UNITS = re.compile(" *[^ ]+| +")
_BATCH_ROWS = 500
_CHUNK_WORDS = 4_000_000


class Model(NamedTuple):
    """Pieces of a model file; ``kind`` is 'unigram' or 'bpe'."""
    kind: str
    pieces: dict[str, int]      # normal and user-defined pieces
    scores: dict[str, float]
    texts: list[bytes]          # what each id decodes to
    byte_ids: tuple[int, ...]   # of the 256 byte pieces, or empty
    unknown: int
    longest: int
    inner: frozenset[str]       # pairs of characters side by side in a piece


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(raw):
        tag = varint()
        if tag & 7 == 0:
            yield tag >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(tag & 7) or varint()
            yield tag >> 3, raw[at: at + size]
            at += size


def read_model(path: str) -> Model:
    import sentencepiece
    with open(path, "rb") as file:
        raw = file.read()
    message = list(_fields(raw))
    trainer = dict(_fields(next((v for k, v in message if k == 2), b"")))
    normalizer = dict(_fields(next((v for k, v in message if k == 3), b"")))
    kind = {1: "unigram", 2: "bpe"}[trainer.get(3, 1)]
    if normalizer.get(2) or normalizer.get(4, 1) or not normalizer.get(3, 1):
        raise ValueError("only models with identity normalisation and a space put first are supported")
    told = sentencepiece.SentencePieceProcessor(model_proto=raw)
    pieces, scores, texts, byte_ids = {}, {}, [], {}
    for i in range(told.get_piece_size()):
        piece = told.id_to_piece(i)
        if told.is_byte(i):
            byte_ids[int(piece[3:-1], 16)] = i
            texts.append(bytes([int(piece[3:-1], 16)]))
        elif told.is_control(i) or told.is_unknown(i):
            texts.append(b"" if told.is_control(i) else " ⁇ ".encode())
        else:
            pieces[piece], scores[piece] = i, told.get_score(i)
            texts.append(piece.replace(SPACE, " ").encode())
    if any(SPACE in p.lstrip(SPACE) for p in pieces):
        raise ValueError("pieces that reach across spaces are not supported")
    inner = frozenset(p[k: k + 2] for p in pieces for k in range(len(p) - 1))
    return Model(kind, pieces, scores, texts, tuple(byte_ids[b] for b in range(256)) if len(byte_ids) == 256 else (),
                 told.unk_id(), max(map(len, pieces)), inner)


def words_of(text: str) -> list[str]:
    """Runs of spaces and what follows them, less the first space (one is put before the text)."""
    text = text.replace(SPACE, " ")
    if not text:
        return []
    if "  " not in text and text[0] != " " and text[-1] != " ":
        return text.split(" ")
    return [x[1:] for x in _UNITS.findall(" " + text)]


class Splitter:
    """Cuts words, their space before them, where no piece reaches across."""

    def __init__(self, inner: frozenset[str]):
        letters = sorted({c for pair in inner for c in pair})
        self.number = np.zeros(0x110000, np.int16 if len(letters) < 32767 else np.int32)
        self.number[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.number[32] = self.number[ord(SPACE)]
        self.held = np.zeros((len(letters) + 1, len(letters) + 1), bool)
        for pair in inner:
            self.held[self.number[ord(pair[0])], self.number[ord(pair[1])]] = True

    def units(self, words: list[str]) -> Iterator[list[str]]:
        """Units of each word, in slices of about a million characters."""
        at = 0
        while at < len(words):
            end, size = at, 0
            while end < len(words) and size < 1_000_000:
                size += len(words[end]) + 1
                end += 1
            some = words[at:end]
            text = " " + " ".join(some)
            kinds = self.number[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")]
            cuts = ~self.held[kinds[:-1], kinds[1:]]
            starts = np.cumsum([0] + [len(w) + 1 for w in some])
            cuts[starts[1:-1] - 1] = True
            places = np.concatenate([[0], np.flatnonzero(cuts) + 1, [len(text)]])
            text = text.replace(" ", SPACE)
            listed = places.tolist()
            pieces = [text[a:b] for a, b in zip(listed, listed[1:])]
            edges = np.searchsorted(places, starts).tolist()
            for a, b in zip(edges, edges[1:]):
                yield pieces[a:b]
            at = end


def units_of(word: str, inner: frozenset[str]) -> list[str]:
    """The units of one word."""
    return next(Splitter(inner).units([word]))


def piece_table(spark: SparkSession, model: Model) -> DataFrame:
    """(piece, id, score, rank, hard): rank orders pieces by falling score, equal scores share one; hard: see ``hard_pieces``."""
    rank = {s: k for k, s in enumerate(sorted(set(model.scores.values()), reverse=True))}
    hard = hard_pieces(model) if model.kind == "bpe" else set()
    rows = [(p, i, float(model.scores[p]), rank[model.scores[p]], p in hard) for p, i in model.pieces.items()]
    return spark.createDataFrame(rows, "piece string, id int, score double, rank long, hard boolean")


def lattice(units: DataFrame, pieces: DataFrame, longest: int, scored: bool = False) -> DataFrame:
    """(unit, count, edges, hard): ``edges`` are the substrings of a unit that are pieces, best first.

    An edge is packed into a long: rank, start (6 bits), size (6), id (26).
    ``scored`` edges are structs (packed, score); others have two characters
    or more. ``units`` has (key, unit, count) with keys of their own. It is
    dealt by key before it is exploded, so the edges of a unit are in one
    task already, and the grouping sorts numbers. A row of size 0 carries
    the unit, and keeps those without any piece and those of more than
    ``LONGEST`` characters, which have no edges.
    """
    parts = int(units.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # told, so that they are not joined into few: rows multiply here
    units = units.select("key", F.coalesce("unit", F.lit("")).alias("unit"), "count").repartition(parts, "key")
    size = F.when(F.length("unit") <= LONGEST, F.length("unit")).otherwise(F.lit(0))
    least = 1 if scored else 2
    starts = units.select("key", "unit", "count", F.explode(F.sequence(F.lit(0), F.greatest(size - least, F.lit(0)))).alias("start"))
    sizes = F.sequence(F.when(F.col("start") == 0, F.lit(0)).otherwise(F.lit(least)), F.least(F.lit(longest), size - F.col("start")))
    spans = starts.select("*", F.explode(sizes).alias("size")).where((F.col("size") == 0) | (F.col("size") >= least))
    some = spans.withColumn("piece", F.substring(F.col("unit"), F.col("start") + 1, F.col("size")))
    nothing = pieces.sparkSession.createDataFrame([("", 0, 0.0, 0, False)], pieces.schema)
    known = pieces.unionByName(nothing).select(F.coalesce("piece", F.lit("")).alias("piece"), "id", "score", "rank", "hard")
    edges = some.join(F.broadcast(known), "piece")  # as many rows as the model file has pieces
    packed = F.shiftleft("rank", 38) + F.shiftleft(F.col("start").cast("long"), 32) + F.shiftleft(F.col("size").cast("long"), 26) + F.col("id")
    first = F.col("size") == 0
    rows = edges.select("key", F.when(first, F.col("unit")).alias("unit"), F.when(first, F.col("count")).alias("count"),
                        F.when(~first, F.struct(packed.alias("packed"), "score") if scored else packed).alias("edge"), "hard")
    return rows.groupBy("key").agg(F.max("unit").alias("unit"), F.max("count").alias("count"),
                                   F.sort_array(F.collect_list("edge")).alias("edges"), F.max("hard").alias("hard"))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` made once a row: a column put into a lambda as it is would be made at every call."""
    return F.transform(F.array(value), use)[0]


def _start(e: Column) -> Column:
    return F.shiftright(e, 32).bitwiseAND(F.lit(63)).cast("int")


def _size(e: Column) -> Column:
    return F.shiftright(e, 26).bitwiseAND(F.lit(63)).cast("int")


def _id(e: Column) -> Column:
    return e.bitwiseAND(F.lit((1 << 26) - 1)).cast("int")


def _bit(k: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), k)


def _codes(unit: Column, edges: Column, cuts: Column) -> Column:
    """Ids between neighbouring cuts; a character without a piece as minus its code point less one."""
    def code(a: Column, i: Column) -> Column:
        size = F.element_at(cuts, i + 2) - a
        found = F.try_element_at(F.filter(edges, lambda e: (_start(e) == a) & (_size(e) == size)), F.lit(1))
        return F.coalesce(_id(found), -1 - F.ascii(F.substring(unit, a + 1, size)))
    return F.transform(F.slice(cuts, 1, F.size(cuts) - 1), code)


def _ends(e: Column) -> Column:
    return _bit(_start(e)) + _bit(_start(e) + _size(e))


def _inside(e: Column) -> Column:
    return F.call_function("shiftleft", _bit(_size(e) - 1) - 1, _start(e) + 1)


def edge_masks(edges: Column) -> Column:
    """For each edge: its two ends, and the places inside it, as bit sets."""
    return F.transform(edges, lambda e: F.struct(_ends(e).alias("ends"), _inside(e).alias("inside")))


def _joins(cuts: Column, mask: Column) -> Column:
    """Whether an edge spans exactly two of the symbols between ``cuts``."""
    return (cuts.bitwiseAND(mask["ends"]) == mask["ends"]) & (F.bit_count(cuts.bitwiseAND(mask["inside"])) == 1)


def merge_fold(unit: Column, masks: Column, hard: Column) -> Column:
    """BPE: as long as an edge spans exactly two symbols, the best one (leftmost of equals) joins them.

    The state is a bit set of the places where symbols begin or end. One
    fold over the edges, best first, does all joins; only where ``hard``
    (see ``hard_pieces``) each round looks at all edges again.
    """
    size = F.length(unit)
    everywhere = _bit(size + 1) - 1

    def joined(cuts: Column, mask: Column) -> Column:
        return F.when(_joins(cuts, mask), cuts.bitwiseAND(F.bitwise_not(mask["inside"]))).otherwise(cuts)

    def rounds(held: Column) -> Column:
        def step(cuts: Column, _: Column) -> Column:
            able = F.filter(held, lambda e: _joins(cuts, e))
            return F.coalesce(F.try_element_at(F.transform(F.slice(able, 1, 1), lambda e: joined(cuts, e)), F.lit(1)), cuts)

        times = F.least(size - 1, F.size(held))
        return F.when(times > 0, F.aggregate(F.sequence(F.lit(1), F.greatest(times, F.lit(1))), everywhere, step)).otherwise(everywhere)

    return let(masks, lambda held: F.when(hard, rounds(held)).otherwise(F.aggregate(held, everywhere, joined)))


def hard_pieces(model: Model) -> set[str]:
    """Pieces with which joins may not happen in the order of the scores.

    What is joined inside a span whose ends stay cuts depends on the span
    alone. So one pass over a unit's edges, best first, does what the rounds
    do, if each piece in the unit has a score of its own and comes out of one
    pass over its own edges whenever it comes out of the rounds.
    """
    shared = Counter(score for piece, score in model.scores.items() if len(piece) > 1)
    hard = set()
    for piece, own in model.pieces.items():
        if len(piece) < 2:
            continue
        spans = [(-model.scores[piece[a:b]], a, b) for a in range(len(piece)) for b in range(a + 2, len(piece) + 1) if piece[a:b] in model.scores]
        cuts = set(range(len(piece) + 1))
        for _, a, b in sorted(spans):
            inner = [k for k in range(a + 1, b) if k in cuts]
            if a in cuts and b in cuts and len(inner) == 1:
                cuts.discard(inner[0])
        if shared[model.scores[piece]] > 1 or len(cuts) > 2 and encode_alone(piece, model) == [own]:
            hard.add(piece)
    return hard


def merged_codes(unit: Column, edges: Column, hard: Column) -> Column:
    """BPE: ids of a unit's symbols; a symbol of one character as minus its code point less one."""
    lone = 1 << 31

    def read(held: Column, cuts: Column) -> Column:
        left = F.filter(held, lambda e: cuts.bitwiseAND(_ends(e) + _inside(e)) == _ends(e))
        alone = F.filter(F.sequence(F.lit(0), F.length(unit) - 1), lambda k: F.call_function("shiftright", cuts, k).bitwiseAND(F.lit(3)) == 3)
        symbols = F.concat(
            F.transform(left, lambda e: F.shiftleft(_start(e).cast("long"), 32) + _id(e)),
            F.transform(alone, lambda k: F.shiftleft(k.cast("long"), 32) + lone + F.ascii(F.substring(unit, k + 1, F.lit(1)))))
        return F.transform(F.sort_array(symbols), lambda s: F.when(s.bitwiseAND(F.lit(lone)) == 0, _id(s)).otherwise(-1 - _id(s)))

    return let(edges, lambda held: let(merge_fold(unit, edge_masks(held), hard), lambda cuts: read(held, cuts)))


def viterbi_fold(unit: Column, scored: Column, unknown: float) -> Column:
    """Unigram: cuts of the best path. State: best score and the step back, for each
    place so far; of equal scores the longer last piece counts, as in the library."""
    def step(acc: Column, end: Column) -> Column:
        into = F.transform(F.filter(scored, lambda s: _start(s["packed"]) + _size(s["packed"]) == end),
                           lambda s: F.struct((acc["best"][_start(s["packed"])] + s["score"]).alias("score"), (-_start(s["packed"])).alias("from")))
        lone = F.struct((acc["best"][end - 1] + F.lit(unknown)).alias("score"), (1 - end).alias("from"))
        single = F.exists(scored, lambda s: (_start(s["packed"]) == end - 1) & (_size(s["packed"]) == 1))
        best = F.array_max(F.when(single, into).otherwise(F.array_append(into, lone)))
        return let(best, lambda b: F.struct(F.array_append(acc["best"], b["score"]).alias("best"), F.array_append(acc["back"], -b["from"]).alias("back")))

    ends = F.sequence(F.lit(1), F.length(unit))
    state = F.aggregate(ends, F.struct(F.array(F.lit(0.0)).alias("best"), F.array(F.lit(0)).alias("back")), step)
    return let(state["back"], lambda back: F.aggregate(
        ends, F.array(F.length(unit)), lambda acc, _: F.when(acc[0] > 0, F.array_prepend(acc, back[acc[0]])).otherwise(acc)))


def best_path_codes(unit: Column, scored: Column, unknown: float) -> Column:
    """Unigram: ids along the best path."""
    return let(scored, lambda held: let(viterbi_fold(unit, held, unknown), lambda cuts: let(
        F.transform(held, lambda e: e["packed"]), lambda edges: _codes(unit, edges, cuts))))


def encode_alone(unit: str, model: Model) -> list[int]:
    """One unit by the same rules without a table, in O(n log n): for units too long for the bit set."""
    if model.kind == "unigram":
        lost = min(model.scores.values()) - 10
        best, back = [0.0] + [-np.inf] * len(unit), [0] * (len(unit) + 1)
        for a in range(len(unit)):
            for b in range(a + 1, min(len(unit), a + model.longest) + 1):
                score = model.scores.get(unit[a:b], lost if b == a + 1 else None)
                if score is not None and best[a] + score > best[b]:
                    best[b], back[b] = best[a] + score, a
        cuts = [len(unit)]
        while cuts[-1]:
            cuts.append(back[cuts[-1]])
        cuts.reverse()
    else:
        after, before = list(range(1, len(unit) + 1)), list(range(-1, len(unit) - 1))
        heap: list[tuple[float, int, int]] = []

        def offer(a: int) -> None:
            if 0 <= a and after[a] < len(unit):
                end = after[after[a]]
                score = model.scores.get(unit[a:end]) if end - a <= model.longest else None
                if score is not None:
                    heapq.heappush(heap, (-score, a, end))

        for a in range(len(unit)):
            offer(a)
        while heap:
            _, a, end = heapq.heappop(heap)
            if after[a] < 0 or after[a] >= len(unit) or after[after[a]] != end:
                continue
            gone = after[a]
            after[a], after[gone] = end, -1
            if end < len(unit):
                before[end] = a
            offer(before[a])
            offer(a)
        cuts = [0]
        while cuts[-1] < len(unit):
            cuts.append(after[cuts[-1]])
    return [-1 - ord(unit[a]) if b == a + 1 and unit[a:b] not in model.pieces else model.pieces[unit[a:b]] for a, b in zip(cuts, cuts[1:])]


def encode_units(units: DataFrame, model: Model) -> DataFrame:
    """(unit, count, ids) of a table of distinct (unit, count), written; ids as in ``ids_of``."""
    spark = units.sparkSession
    units = materialize(units.withColumn("key", F.monotonically_increasing_id()), "units", _BATCH_ROWS)  # written, so that keys stay
    unigram = model.kind == "unigram"
    table = lattice(units, piece_table(spark, model), model.longest, scored=unigram)
    if unigram:
        codes = best_path_codes(F.col("unit"), F.col("edges"), min(model.scores.values()) - 10)
    else:
        codes = merged_codes(F.col("unit"), F.col("edges"), F.col("hard"))
    coded = materialize(table.select("unit", "count", F.when(F.length("unit") <= LONGEST, codes).alias("codes")), "encoded", sort_groups=True)
    shared = spark.sparkContext.broadcast(model)

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Codes to ids; units too long for the fold have no codes yet."""
        for batch in batches:
            ids = [ids_of(encode_alone(u, shared.value) if c is None else c, shared.value)
                   for u, c in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ids, pa.binary())], names=["unit", "count", "ids"])

    told = materialize(coded.mapInArrow(spell, "unit string, count long, ids binary"), "spelt")
    discard(units)
    discard(coded)
    return told


def number_units(docs: DataFrame, model: Model, held_words: int) -> DataFrame:
    """Documents as numbers of their units, in chunks of documents with a list of units each; written in buckets by chunk.

    Two kinds of rows: (chunk, _doc, numbers), numbers as ``_planes`` and
    null for null text, and (chunk, at, units), the units numbered from
    ``at`` on, frequent ones first. A chunk is full at ``held_words`` distinct
    words or ``_CHUNK_WORDS`` words; no chunk reaches across tasks.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Splitter(model.inner))
    kind = docs.schema["_doc"].dataType.simpleString()
    names = ["chunk", "_doc", "numbers", "at", "units"]

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        words: defaultdict[str, int] = defaultdict()
        words.default_factory = words.__len__  # a new word gets the next number
        ids: list[object] = []
        texts: list[np.ndarray | None] = []

        def emit(id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
            units: defaultdict[str, int] = defaultdict()
            units.default_factory = units.__len__
            flat, edges = array("I"), [0]
            for own in shared.value.units(list(words)):
                flat.extend(map(units.__getitem__, own))
                edges.append(len(flat))
            # frequent units get small numbers: the planes compress
            times = np.zeros(len(words), np.int64)
            for at in range(0, len(texts), _BATCH_ROWS):
                times += np.bincount(np.concatenate([np.zeros(0, np.uint32)] + [t for t in texts[at: at + _BATCH_ROWS] if t is not None]), minlength=len(words))
            codes = np.frombuffer(flat, np.uint32)
            order = np.argsort(-np.bincount(codes, np.repeat(times, np.diff(edges)), len(units)), kind="stable")
            rank = np.empty(len(units), np.uint32)
            rank[order] = np.arange(len(units))
            spelt = pa.LargeListArray.from_arrays(pa.array(edges, pa.int64()), pa.array(rank[codes]))
            for at in range(0, len(ids), _BATCH_ROWS):
                some = texts[at: at + _BATCH_ROWS]
                told = spelt.take(pa.array(np.concatenate([t for t in some if t is not None] or [np.zeros(0, np.uint32)])))
                raw = memoryview(told.flatten().to_numpy(zero_copy_only=False)).cast("B")
                ends = (np.concatenate([[0], np.cumsum(pc.list_value_length(told).to_numpy(zero_copy_only=False))]) * 4)[
                    np.cumsum([0] + [0 if t is None else len(t) for t in some])].tolist()
                numbers = [None if t is None else _planes(raw[a:b]) for t, a, b in zip(some, ends, ends[1:])]
                n = len(some)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk] * n, pa.int64()), pa.array(ids[at: at + n], id_type), pa.array(numbers, pa.binary()),
                     pa.nulls(n, pa.int32()), pa.nulls(n, pa.list_(pa.string()))], names=names)
            names_of = list(units)
            listed = [names_of[k] for k in order.tolist()]
            for at in range(0, len(listed), 65536):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk], pa.int64()), pa.nulls(1, id_type), pa.nulls(1, pa.binary()),
                     pa.array([at], pa.int32()), pa.array([listed[at: at + 65536]], pa.list_(pa.string()))], names=names)
            words.clear()
            ids.clear()
            texts.clear()

        held, id_type = 0, None
        for batch in batches:
            id_type = batch.column(0).type
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = words_of(text.as_py() or "")
                ids.append(doc)
                texts.append(np.fromiter(map(words.__getitem__, own), np.uint32, len(own)) if text.is_valid else None)
                held += len(own)
                if len(words) > held_words or held > _CHUNK_WORDS:
                    yield from emit(id_type)
                    chunk, held = chunk + 1, 0
        if ids:
            yield from emit(id_type)

    numbered = docs.mapInArrow(number, f"chunk long, _doc {kind}, numbers binary, at int, units array<string>")
    return materialize(numbered, "numbered", _BATCH_ROWS, bucket_by="chunk")


def ids_of(codes: Sequence[int], model: Model) -> bytes:
    """Ids as unsigned 32-bit, little-endian. A negative code is a character: its piece, else its bytes, else unknown."""
    out: list[int] = []
    for code in codes:
        if code >= 0:
            out.append(code)
        elif (own := model.pieces.get(chr(-1 - code))) is not None:
            out.append(own)
        elif model.byte_ids:
            out += [model.byte_ids[b] for b in chr(-1 - code).encode()]
        else:
            out.append(model.unknown)
    return np.array(out, "<u4").tobytes()


def _planes(numbers: bytes | memoryview) -> bytes:
    """Unsigned 32-bit numbers as all their first bytes, then all second ones, and so on."""
    return np.frombuffer(numbers, np.uint8).reshape(-1, 4).T.tobytes()


def _numbers(planes: bytes) -> bytes:
    """What ``_planes`` was made from."""
    return np.frombuffer(planes, np.uint8).reshape(4, -1).T.tobytes()


def _gather(values: pa.LargeBinaryArray, rows: list[bytes | None]) -> list[bytes | None]:
    """For each row, an array of unsigned 32-bit numbers: the values of these numbers, one behind the other."""
    told = values.take(pa.array(np.frombuffer(b"".join([r for r in rows if r]), "<u4")))
    places = np.concatenate([[0], np.cumsum(pc.binary_length(told).to_numpy(zero_copy_only=False))])
    ends = places[np.cumsum([0] + [len(r or b"") // 4 for r in rows])].tolist()
    raw = memoryview(told.buffers()[2] or b"")
    return [None if r is None else bytes(raw[a:b]) for r, a, b in zip(rows, ends, ends[1:])]


def encode(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", head_units: int = HEAD_UNITS,
           held_words: int = HELD_WORDS) -> DataFrame:
    """(id, ids) of every row: ids as bytes, unsigned 32-bit, little-endian."""
    spark = docs.sparkSession
    numbered = number_units(docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("_text")), model, held_words)
    listed = numbered.where(F.col("units").isNotNull()).select("chunk", "at", F.posexplode("units").alias("pos", "unit"))
    listed = listed.select("chunk", (F.col("at") + F.col("pos")).alias("number"), "unit")
    table = encode_units(listed.groupBy("unit").agg(F.count("*").alias("count")), model)
    # at most head_units rows of at most LONGEST characters
    top = table.where(F.length("unit") <= LONGEST).orderBy(F.desc("count"), "unit").limit(head_units).select("unit", "ids").toArrow()
    shared = spark.sparkContext.broadcast(dict(zip(top.column("unit").to_pylist(), top.column("ids").to_pylist())))
    rest = listed.join(F.broadcast(spark.createDataFrame(top.select(["unit"]), "unit string")), "unit", "left_anti")
    found = materialize(rest.join(table.select("unit", "ids"), "unit").select("chunk", "number", "ids"), "rare")
    discard(table)

    def write(rows: pa.Table, rare: pa.Table) -> pa.Table:
        """The documents of one chunk."""
        is_list = pc.is_valid(rows.column("at"))
        lists = rows.filter(is_list).sort_by("at").column("units")
        parts = [shared.value.get(u) for some in lists for u in some.values.to_pylist()]
        for number, ids in zip(rare.column("number").to_pylist(), rare.column("ids").to_pylist()):
            parts[number] = ids
        if None in parts:
            raise ValueError("a unit without ids")
        values = pa.array(parts, pa.large_binary())
        texts = rows.filter(pc.invert(is_list))
        out = []
        for at in range(0, len(texts), _BATCH_ROWS):
            numbers = [None if n is None else _numbers(n) for n in texts.column("numbers").slice(at, _BATCH_ROWS).to_pylist()]
            out.append(pa.array(_gather(values, numbers), pa.binary()))
        return pa.Table.from_arrays([texts.column("_doc"), pa.chunked_array(out, pa.binary())], names=[id_col, "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return numbered.groupBy("chunk").cogroup(found.groupBy("chunk")).applyInArrow(write, f"`{id_col}` {kind}, ids binary")


def decode(encoded: DataFrame, model: Model, id_col: str = "doc_id") -> DataFrame:
    """(id, ids, text) from (id, ids); null ids give null text."""
    shared = encoded.sparkSession.sparkContext.broadcast(model.texts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = pa.array(shared.value, pa.large_binary())
        for whole in batches:
            for at in range(0, whole.num_rows, _BATCH_ROWS):
                batch = whole.slice(at, _BATCH_ROWS)
                out = [None if raw is None else raw.removeprefix(b" ").decode("utf-8", "replace") for raw in _gather(texts, batch.column(1).to_pylist())]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string())], names=[id_col, "ids", "text"])

    kind = encoded.schema[id_col].dataType.simpleString()
    return encoded.select(id_col, "ids").mapInArrow(run, f"`{id_col}` {kind}, ids binary, text string")
