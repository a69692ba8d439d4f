"""Conversation structure repair: the lightest edits that give a conversation a legal shape.

Knuth's lightest derivation. A conversation is a sequence of rows, the
legal shapes are the role initials ``(s?(ua)+)?``. Items are deductions
with a weight (cost, audit), audit being the initials of the edits: an
item (i, p) says how rows i.. of a segment lead from grammar state p to
the segment's last state. Each edit is a superior function of one item
(it prepends its initial, adds its cost and never yields a smaller
weight); an agenda pops items by (cost, rows used, audit), so an item is
final when first popped, and the search ends when its goals are final.
Prepending keeps the order of audits, so ties fall to the ASCII-least.
Segments hold at most ``SEGMENT`` rows: rows are dealt by ranges of
(conversation, turn), each task derives the items of its segments for
every pair of states, and a second deduction joins the items of a
conversation's segments in order (two antecedents, weights added). Audits
of equal cost over the same rows are never beginnings of one another, so
this join is monotone too. A conversation of any length is thus spread over
tasks; what goes through one task for each conversation is its segments'
items and, for the repaired rows, its rows one after another in a stream.

Edits: Keep 0; Rerole to user or assistant 3; Delete 4, the only edit of a
blank or duplicate row; Insert an empty user or assistant row 3. A row kept or
reroled though truncated costs 3 more. Rows are ordered by turn (null
first), role, the first 64 characters of the text, then its SHA-256.

Cases: null role or text is one space. Null conversation ids are one
conversation. A turn of -2**63 counts as null for duplicates only. Rows that are
not ``present`` merely name their conversation. A conversation without rows has
zeros, an empty audit and no repaired rows; an empty table gives none. Repeated
rows are duplicates of the first. Other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import NULL_ID, materialize

SEGMENT = 64
KEEP, REROLE, DELETE, INSERT, LATE = 0, 3, 4, 3, 3
_BLANKS = " \t\n\x0b\x0c\r"
#: Grammar states: 0 nothing yet, 1 after system, 2 after user, 3 after assistant. {state: [(state before, role)]}
_BEFORE = {0: [], 1: [(0, "s")], 2: [(0, "u"), (1, "u"), (3, "u")], 3: [(2, "a")]}
_ACCEPTING = (0, 3)
_LEGAL = {"su", "ua", "au"}
_NAMES = {"u": "user", "a": "assistant"}


@lru_cache(maxsize=20_000)
def derive(signs: str) -> tuple[tuple[int, int, int, str], ...]:
    """(state before, state after, cost, audit) of the lightest edits of a segment, for all pairs that have any.

    ``signs``: a letter a row: d must be deleted; otherwise the role's
    initial (x: another), upper case if truncated.
    """
    found = []
    for last in range(4):
        goals = {0, 1} if last == 1 else {0} if last == 0 else {0, 1, 2, 3}
        agenda, final = [(0, 0, "", len(signs), last)], {}
        while agenda and goals:
            cost, used, audit, i, state = heapq.heappop(agenda)
            if (i, state) in final:
                continue
            final[i, state] = cost, audit
            if not i and state in goals:
                goals.discard(state)
                found.append((state, last, cost, audit))
            sign = signs[i - 1] if i else "d"
            late = LATE if sign.isupper() else 0
            if i:
                heapq.heappush(agenda, (cost + DELETE, used + 1, "D" + audit, i - 1, state))
            for before, role in _BEFORE[state]:
                if role != "s":
                    heapq.heappush(agenda, (cost + INSERT, used, "I" + audit, i, before))
                if sign == "d":
                    continue
                if sign.lower() == role:
                    heapq.heappush(agenda, (cost + KEEP + late, used + 1, "K" + audit, i - 1, before))
                elif role != "s":
                    heapq.heappush(agenda, (cost + REROLE + late, used + 1, "R" + audit, i - 1, before))
    return tuple(found)


class Derivation:
    """An item over the first segments of a conversation: cost, and the audit as a chain of parts."""

    __slots__ = ("cost", "part", "parent")

    def __init__(self, cost: int, part: str, parent: Derivation | None):
        self.cost, self.part, self.parent = cost, part, parent

    def __lt__(self, other: Derivation) -> bool:
        if self.cost != other.cost:
            return self.cost < other.cost
        a, b, mine, others = self, other, [], []
        while a is not b:  # both have as many parts
            mine.append(a.part)
            others.append(b.part)
            a, b = a.parent, b.parent
        return "".join(reversed(mine)) < "".join(reversed(others))

    def audit(self) -> str:
        parts, at = [], self
        while at is not None:
            parts.append(at.part)
            at = at.parent
        return "".join(reversed(parts))


def join_items(items: dict[int, Derivation], segment: list[tuple[int, int, int, str]]) -> dict[int, Derivation]:
    """Items after one more segment; every state is final when first popped."""
    agenda = [(Derivation(items[before].cost + cost, audit, items[before]), after)
              for before, after, cost, audit in segment if before in items]
    heapq.heapify(agenda)
    final: dict[int, Derivation] = {}
    while agenda:
        item, state = heapq.heappop(agenda)
        final.setdefault(state, item)
    return final


def _clean(rows: DataFrame, conv: str, turn: str, role: str, text: str, present: str | None) -> DataFrame:
    return rows.select(
        F.coalesce(F.col(conv).cast("long"), F.lit(NULL_ID)).alias("c"), F.col(turn).cast("long").alias("t"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"), F.coalesce(F.col(text), F.lit(" ")).alias("text"),
        (F.col(present) if present else F.lit(True)).alias("present"))


def _digest() -> Column:
    return F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))


def _head() -> Column:
    return F.substring("text", 1, 64)


_SEGMENT_SCHEMA = ("c long, pid int, seg int, n long, blank long, duplicate long, truncated long, illegal long, first string, last string, "
                   "low long, high long, turns long, items array<struct<before: int, after: int, cost: long, audit: string>>")


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a range, sorted, to segments: counts and items. Columns c, t, initial, blank, cut, later, present, d."""
    schema = pa.schema([("c", pa.int64()), ("pid", pa.int32()), ("seg", pa.int32()), *((k, pa.int64()) for k in (
        "n", "blank", "duplicate", "truncated", "illegal")), ("first", pa.string()), ("last", pa.string()),
        *((k, pa.int64()) for k in ("low", "high", "turns")),
        ("items", pa.list_(pa.struct([("before", pa.int32()), ("after", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])))])
    pid, seg, out = TaskContext.get().partitionId(), 0, []
    now: dict | None = None
    signs: list[str] = []
    before = None  # the row before, if of the same conversation

    def close() -> None:
        nonlocal now, seg
        if now is not None:
            items = [dict(zip(("before", "after", "cost", "audit"), x)) for x in derive("".join(signs))]
            out.append(now | {"pid": pid, "seg": seg, "items": items})
            seg += 1
            signs.clear()
            now = None

    for batch in batches:
        for c, t, initial, blank, cut, later, present, d in zip(*(column.to_pylist() for column in batch.columns)):
            if now is None or now["c"] != c or now["n"] == SEGMENT:
                close()
                now = dict.fromkeys(("n", "blank", "duplicate", "truncated", "illegal", "turns"), 0) | dict.fromkeys(
                    ("first", "last", "low", "high")) | {"c": c}
            if not present:
                continue
            twin = before == (c, t, d)
            before = c, t, d
            sign = "d" if blank or later or twin else initial if initial in ("s", "u", "a") else "x"
            now["blank" if blank else "duplicate" if sign == "d" else "truncated"] += blank or sign == "d" or cut
            signs.append(sign.upper() if cut and sign != "d" else sign)
            if now["n"]:
                now["illegal"] += now["last"] + initial not in _LEGAL
            else:
                now["first"] = initial
            now["last"] = initial
            now["n"] += 1
            if t is not None:
                now["turns"] += now["high"] != t
                now["low"] = t if now["low"] is None else now["low"]
                now["high"] = t
        if len(out) >= 2000:
            yield pa.RecordBatch.from_pylist(out, schema)
            out = []
    close()
    if out:
        yield pa.RecordBatch.from_pylist(out, schema)


_SUMMARY = pa.schema([("c", pa.int64()), *((k, pa.int64()) for k in (
    "gaps", "blank", "duplicate", "truncated", "illegal", "cost")), ("audit", pa.string())])


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted segments to one row a conversation."""
    rows = (row for batch in batches for part in range(0, len(batch), 256) for row in batch.slice(part, 256).to_pylist())
    out = []
    for c, segments in groupby(rows, lambda row: row["c"]):
        sums = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        items, last, low, high, turns = {0: Derivation(0, "", None)}, None, None, None, 0
        for s in segments:
            if not s["n"]:
                continue
            items = join_items(items, [tuple(x.values()) for x in s["items"]])
            for k in sums:
                sums[k] += s[k]
            if last is not None:
                sums["illegal"] += last + s["first"] not in _LEGAL
            last = s["last"]
            if s["low"] is not None:
                turns += s["turns"] - (s["low"] == high)
                low, high = s["low"] if low is None else low, s["high"]
        best = min(items[q] for q in _ACCEPTING if q in items)
        out.append(sums | {"c": c, "gaps": 0 if low is None else high - low + 1 - turns, "cost": best.cost, "audit": best.audit()})
        if len(out) >= 2000:
            yield pa.RecordBatch.from_pylist(out, _SUMMARY)
            out = []
    if out:
        yield pa.RecordBatch.from_pylist(out, _SUMMARY)


_REPAIRED = pa.schema([("c", pa.int64()), ("place", pa.int64()), ("edit", pa.string()), ("t", pa.int64()), ("role", pa.string()), ("text", pa.string())])


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows, each conversation's audit first, to its repaired rows. Columns c, audit, t, role, text."""
    out: list[tuple] = []
    size = place = at = state = 0
    audit, c = "", None

    def put(edit: str, t: int | None, role: str, initial: str, text: str) -> None:
        nonlocal size, place, state
        out.append((c, place, edit, t, role, text))
        state = {"s": 1, "u": 2, "a": 3}[initial]
        place += 1
        size += len(text) + 64

    def insert() -> None:
        nonlocal at
        while audit[at: at + 1] == "I":
            role = "a" if state == 2 else "u"
            put("I", None, _NAMES[role], role, "")
            at += 1

    def batch_out() -> pa.RecordBatch:
        nonlocal size
        made = pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], f.type) for k, f in enumerate(_REPAIRED)], schema=_REPAIRED)
        out.clear()
        size = 0
        return made

    for batch in batches:
        for part in range(0, len(batch), 256):
            for conv, edits, t, role, text in zip(*(x.to_pylist() for x in batch.slice(part, 256).columns)):
                if edits is not None:
                    if c is not None:
                        insert()
                    c, audit, at, place, state = conv, edits, 0, 0, 0
                    continue
                insert()
                edit = audit[at]
                at += 1
                if edit == "K":
                    put("K", t, role, role[0], text)
                elif edit == "R":
                    new = "a" if state == 2 else "u"
                    put("R", t, _NAMES[new], new, text)
                if size > 4_000_000:
                    yield batch_out()
    if c is not None:
        insert()
    yield batch_out()


def _nullable(c: Column) -> Column:
    return F.when(c != NULL_ID, c)


def repair(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
           present_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(one row per conversation: gaps, blank, duplicate, truncated, illegal, cost, audit;
    the repaired rows: place, edit, turn, role, text; each partition holds whole conversations in order)."""
    clean = _clean(rows, conv_col, turn_col, role_col, text_col, present_col)
    shown = F.rtrim("text", F.lit(_BLANKS))
    slim = clean.select("c", "t", "role", _head().alias("head"), _digest().alias("d"), (shown == "").alias("blank"),
                        (~F.right(shown, F.lit(1)).isin(".", "!", "?")).alias("cut"), "present",
                        F.coalesce("t", F.lit(NULL_ID)).alias("at"))
    # texts that one conversation holds at several turns
    again = slim.where("present AND NOT blank").groupBy("c", "d").agg(F.min("at").alias("first_at"), F.max("at").alias("last_at")).where(
        "first_at < last_at").select("c", "d", "first_at")
    marked = slim.join(again, ["c", "d"], "left").withColumn("later", F.coalesce(F.col("at") > F.col("first_at"), F.lit(False)))
    ordered = marked.repartitionByRange("c", "t", "role", "head").sortWithinPartitions("c", "t", "role", "head", "d")
    segments = ordered.select("c", "t", F.substring("role", 1, 1).alias("initial"), "blank", "cut", "later", "present", "d").mapInArrow(
        _segments, _SEGMENT_SCHEMA)
    summary = materialize(segments.repartition("c").sortWithinPartitions("c", "pid", "seg").mapInArrow(
        _joined, "c long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"), "repair-summary")
    nothing = F.lit(None)
    both = summary.select("c", "audit", nothing.cast("long").alias("t"), F.lit("").alias("role"), F.lit("").alias("text")).unionByName(
        clean.where("present").select("c", nothing.cast("string").alias("audit"), "t", "role", "text"))
    repaired = both.repartition("c").sortWithinPartitions("c", F.col("audit").isNull(), "t", "role", _head(), _digest()).mapInArrow(
        _edited, "c long, place long, edit string, t long, role string, text string")
    key = _nullable(F.col("c")).alias(conv_col)
    return summary.select(key, *(f.name for f in _SUMMARY if f.name != "c")), repaired.select(key, "place", "edit", F.col("t").alias(turn_col), "role", "text")


def digests(repaired: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """SHA-256 of each conversation's ``role:text`` lines, joined by newlines; rows as ``repair`` leaves them."""
    import hashlib

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, sums = [], []
        now = None
        for batch in batches:
            for part in range(0, len(batch), 256):
                for conv, place, role, text in zip(*(x.to_pylist() for x in batch.slice(part, 256).columns)):
                    if place == 0:
                        if now is not None:
                            sums.append(now.hexdigest())
                        ids.append(conv)
                        now = hashlib.sha256(f"{role}:{text}".encode())
                    else:
                        now.update(f"\n{role}:{text}".encode())
        if now is not None:
            sums.append(now.hexdigest())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sums, pa.string())], names=[conv_col, "repaired_sha256"])

    return repaired.select(conv_col, "place", "role", "text").mapInArrow(digest, f"`{conv_col}` long, repaired_sha256 string")


def damage(conversations: DataFrame) -> DataFrame:
    """The conversations table with planted faults, by crc32(``conv_id:turn``) % 20: 0 drops a row (it stays, not present),
    1 empties its text, 2 removes its ``[.!?]``, 3 repeats it, 4 makes its role user. Nulls are one space."""
    code = F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
                            F.coalesce(F.col("turn").cast("string"), F.lit(" ")))) % 20
    role, text = (F.coalesce(F.col(k), F.lit(" ")) for k in ("role", "text"))
    return conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), code.alias("_code")).select(
        "conv_id", "turn", F.when(F.col("_code") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("_code") == 1, "").when(F.col("_code") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        (F.col("_code") != 0).alias("present"),
        F.explode(F.when(F.col("_code") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")
