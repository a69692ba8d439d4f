"""Best-fit packing of documents into sequences, by a tree of local rounds.

Every task best-fits the pieces of its own documents, largest first, and
emits the bins that are nearly full. Underfull bins become the items of
the next round: they are dealt by hash into fewer, bounded groups, each
group best-fits them again, and so on until one bounded group is left or
a round finds (almost) nothing to merge, as when all bins are over half
full. No task ever holds more than ``group_rows`` bins.

Cases: a null text is an empty one and gives the closing id only. Repeated
rows are packed each. Only id and text are read, so further columns cannot
clash. An empty table gives no rows. Texts of any length are cut into
pieces; the first piece of a long one takes the remainder, the others are
full. Ties between equally full bins go to the latest opened.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize

CAPACITY = 2048
CLOSING_ID = 0
SLACK = 24            # a bin with at most so much room is emitted
GROUP_ROWS = 16_384   # bins in one group of a round
FLUSH_ROWS = 65_536   # pieces that a scanning task holds
CACHE_ENTRIES = 400_000
#: White space other than space and newline. Texts that hold it, or a space
#: beside other white space, are encoded whole: their runs may be one token.
_RARE = re.compile(r"[\t\v\f\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def byte_alphabet() -> dict[str, int]:
    """The byte of each character of a byte-level vocabulary: printable bytes
    stand for themselves, the others for the characters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Token ids of a text as bytes (unsigned 32-bit, little-endian).

    The vocabulary is read from a byte-level file of ``tokenizers``; its ids
    follow the order of merges, so they serve as ranks for the quicker engine
    (the tests hold the ids against ``tokenizers`` itself). A token never
    crosses from a word to the space after it: words with the space before
    them are encoded one by one, frequent ones from a bounded cache.

    As in ``tokenizers``, an added token of the file that stands in a text is
    one id, and what lies between added tokens is encoded alone.
    """

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        added = told.get("added_tokens") or ()
        for x in added:
            if x["single_word"] or x["lstrip"] or x["rstrip"]:
                raise ValueError(f"added token {x['content']!r}: single_word, lstrip and rstrip are not supported")
        self.added = {x["content"]: np.array([x["id"]], "<u4").tobytes() for x in added}
        longest = sorted(self.added, key=len, reverse=True)
        self.cuts = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if added else None
        to_byte = byte_alphabet()
        ranks = {bytes(to_byte[c] for c in token): i for token, i in told["model"]["vocab"].items() if token not in self.added}
        self.engine = tiktoken.Encoding("byte-level", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.cache: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return np.array(self.engine.encode_ordinary(text), "<u4").tobytes()

    def _word(self, word: str) -> bytes:
        ids = self.whole(" " + word)
        if len(word) <= 64 and len(self.cache) < CACHE_ENTRIES:
            self.cache[word] = ids
        return ids

    def __call__(self, text: str) -> bytes:
        if self.cuts is None or not self.cuts.search(text):
            return self._plain(text)
        return b"".join([self.added[x] if k % 2 else self._plain(x) for k, x in enumerate(self.cuts.split(text))])

    def _plain(self, text: str) -> bytes:
        if "  " in text or "\n " in text or " \n" in text or text[-1:] == " " or _RARE.search(text):
            return self.whole(text)
        get, word = self.cache.get, self._word
        first, *more = text.split(" ")
        return self.whole(first) + b"".join([get(x) or word(x) for x in more])


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def cut(ids: bytes, capacity: int) -> Iterator[tuple[int, int]]:
    """(start, length) of the pieces of a document of len(ids) / 4 ids."""
    total = len(ids) // 4
    first = total % capacity or min(total, capacity)
    yield 0, first
    for start in range(first, total, capacity):
        yield start, capacity


def best_fit(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Items of each bin: best-fit decreasing, O(1) a step by a bit set of free room."""
    bins: list[list[int]] = []
    free: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0
    for item in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[item])
        fits = rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            at = free[room].pop()
            if not free[room]:
                rooms ^= 1 << room
            bins[at].append(item)
        else:
            room, at = capacity, len(bins)
            bins.append([item])
        room -= size
        if room:
            free[room].append(at)
            rooms |= 1 << room
    return bins


def _member_type(with_ids: bool) -> str:
    return "struct<doc_id:bigint,piece:int,start:bigint,length:bigint,ids_crc32:bigint,offset:bigint" + (",ids:binary>" if with_ids else ">")


def _bins_schema(with_ids: bool) -> str:
    return f"sequence_id long, used int, done boolean, members array<{_member_type(with_ids)}>"


def _merge(items: list[tuple[int, list[dict]]], capacity: int, slack: int, base: int, arrow: pa.Schema) -> pa.RecordBatch:
    rows = []
    for chosen in best_fit(np.array([used for used, _ in items], np.int64), capacity):
        used, members = 0, []
        for i in chosen:
            size, own = items[i]
            members += [m | {"offset": m["offset"] + used} for m in own]
            used += size
        rows.append({"sequence_id": base + len(rows), "used": used, "done": capacity - used <= slack, "members": members})
    return pa.RecordBatch.from_pylist(rows, schema=arrow)


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text",
         slack: int = SLACK, group_rows: int = GROUP_ROWS, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset
    (and, on demand, the piece's ids as bytes). ``tokenizer`` is the file's path."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string
    schema = _bins_schema(with_ids)
    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        closing = np.array([CLOSING_ID], "<u4").tobytes()
        task, items, base = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(text.as_py() or "") + closing
                for piece, (start, length) in enumerate(cut(ids, capacity)):
                    own = ids[4 * start: 4 * (start + length)]
                    member = {"doc_id": doc_id, "piece": piece, "start": start, "length": length, "ids_crc32": zlib.crc32(own), "offset": 0}
                    items.append((length, [member | {"ids": own} if with_ids else member]))
                if len(items) >= FLUSH_ROWS:
                    yield (out := _merge(items, capacity, slack, task + base, arrow))
                    items, base = [], base + out.num_rows
        if items:
            yield _merge(items, capacity, slack, task + base, arrow)

    bins = materialize(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
                       .mapInArrow(scan, schema), "packing")
    full = [bins.where("done")]
    left = bins.where("NOT done").drop("done")
    count, level = left.count(), 0
    while count:
        level += 1
        groups = -(-count // group_rows)
        dealt = left.withColumn("group", F.pmod(F.xxhash64("sequence_id", F.lit(level)), F.lit(groups)).cast("long"))
        merged = materialize(dealt.groupBy("group").applyInArrow(_merger(capacity, slack, level, arrow), schema), "packing")
        after = merged.where("NOT done").count()
        if groups == 1 or after > 0.98 * count:
            full.append(merged)
            break
        full.append(merged.where("done"))
        left, count = merged.where("NOT done").drop("done"), after
    out = full[0]
    for more in full[1:]:
        out = out.unionByName(more)
    return out.select("sequence_id", F.inline("members")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", *(["ids"] if with_ids else []))


def _merger(capacity: int, slack: int, level: int, arrow: pa.Schema):
    def merge(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        rows = table.select(["sequence_id", "used", "members"]).sort_by("sequence_id").to_pylist()
        base = (level << 56) + (key[0].as_py() << 28)
        return pa.Table.from_batches([_merge([(r["used"], r["members"]) for r in rows], capacity, slack, base, arrow)])
    return merge
