"""Secret scans with multipart credential linking, in DataFrame functions only.

Base rules find assignments, access keys and long hexadecimal runs. Parts
of a credential that are too weak to report alone (identifiers, key-like
strings, endpoints) are gathered too; an interval join on (document, bin
of ``scope`` characters) puts each beside the parts around it, and it is
reported only if complementary parts lie within ``scope`` characters, from
the end of one to the start of the other. A part stands in every bin from
its start to its end; a pair counts in the first bin that both share. The
bins bound the join by the characters of a scope, not of a document.

Spans are in code points, end exclusive, ordered by start, then by kind as
listed in ``KINDS``. Cases: an empty table gives no rows; null text is empty and has no spans. Rows with
the same id and text have the same spans; a null id is an id of its own.
Only id and text are read by ``secret_spans``; ``redact`` keeps every
column and type and replaces the text alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import doc_key, materialize

ASSIGN = (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
#: Leftmost runs shorter than the rule asks are dropped; since a run is maximal, asking for its length is the same.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
WEAK = {
    "id": r"""((?i:access_?key_?id|client_?id|account_?id|user_?name|login|user))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.@-]{4,})""",
    "key": r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{20,}={0,2}",
    "endpoint": r"""(?i:https?|ftp|jdbc:[a-z]+|postgres|mysql|mongodb|redis|amqp)://[^\s"'<>]{4,}""",
}
KINDS = ("assign", "access", "hex", *WEAK)
SCOPE = 200
MASK = "[SECRET]"
_SPAN = "array<struct<start:int,kind:int,end:int>>"
_BLOCK = 256   # matches that a fold holds


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` made once a row: put into a lambda as it is, it would be made at every call."""
    return F.transform(F.array(value), use)[0]


def _blocks(items: Column) -> Column:
    """An array in parts of ``_BLOCK``: folds that append copy what they hold, so they hold one part only."""
    return _let(items, lambda held: F.transform(
        F.sequence(F.lit(0), F.floor((F.size(held) - 1) / _BLOCK).cast("int")), lambda k: F.slice(held, k * _BLOCK + 1, _BLOCK)))


def _spans(text: Column, pattern: str, kind: int, least: int = 0) -> Column:
    """Spans of all matches. The text between two matches and the matches
    themselves, counted on, give the places; ``least``: of group 2."""
    hit = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(2 if least else 0))
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(hit))
    sizes = F.zip_with(F.zip_with(gaps, hit, lambda g, h: F.struct(F.length(g).alias("gap"), F.length(h).alias("size"))), value,
                       lambda x, v: F.struct(x["gap"].alias("gap"), x["size"].alias("size"), (F.length(v) >= least).alias("good")))
    none = F.array().cast(_SPAN)

    def places(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda acc, x: acc + x["gap"] + x["size"]))
        starts = F.aggregate(totals, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")), lambda acc, t: F.struct(
            (acc["at"] + t).alias("at"), F.array_append(acc["out"], acc["at"]).alias("out")))
        return _let(starts["out"], lambda begin: F.flatten(F.transform(blocks, lambda b, k: F.aggregate(
            b, F.struct(F.get(begin, k).alias("at"), none.alias("out")), lambda acc, x: _advance(acc, x["gap"], x["size"], x["good"], kind))["out"])))

    return F.when(F.size(hit) > 0, _let(_blocks(sizes), places)).otherwise(none)


def _advance(acc: Column, gap: Column, size: Column, good: Column, kind: int) -> Column:
    start = acc["at"] + gap
    span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), (start + size).alias("end"))
    return F.struct((start + size).alias("at"), F.when(good, F.array_append(acc["out"], span)).otherwise(acc["out"]).alias("out"))


def base_spans(text: Column) -> Column:
    """Sorted spans of the three base rules; the cheap test first, as few texts hold any."""
    none = F.array().cast(_SPAN)
    assign = F.when(text.rlike(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]"""), _spans(text, ASSIGN, 0, least=6)).otherwise(none)
    access = F.when(F.contains(text, F.lit("AKIA")), _spans(text, ACCESS, 1)).otherwise(none)
    hexes = F.when(text.rlike(HEX), _spans(text, HEX, 2)).otherwise(none)
    return F.array_sort(F.concat(assign, access, hexes))


def weak_spans(text: Column) -> Column:
    """Spans that count only beside complementary parts. A key-like string has a digit and both cases."""
    none = F.array().cast(_SPAN)
    ids = F.when(text.rlike(WEAK["id"]), _spans(text, WEAK["id"], 3)).otherwise(none)
    keys = F.when(text.rlike(WEAK["key"]), _spans(text, WEAK["key"], 4)).otherwise(none)
    mixed = F.filter(keys, lambda s: _is_mixed(F.substring(text, s["start"] + 1, s["end"] - s["start"])))
    ends = F.when(F.contains(text, F.lit("://")), _spans(text, WEAK["endpoint"], 5)).otherwise(none)
    return F.concat(ids, mixed, ends)


def _is_mixed(word: Column) -> Column:
    return word.rlike("[0-9]") & word.rlike("[a-z]") & word.rlike("[A-Z]")


def _found(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(*doc_key(id_col, text_col), F.col(id_col).alias("_doc"), text.alias("_text"))
    return rows.select("_id", "_th", "_doc", base_spans(F.col("_text")).alias("base"), weak_spans(F.col("_text")).alias("weak"))


def link_parts(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """(_id, _th, linked): the weak spans beside complementary parts.

    Identifiers (access keys, id) complement secrets (assign, hex, key) and
    the reverse; an endpoint needs one of each in its scope.
    """
    some = found.where(F.size("weak") > 0)
    parts = some.select("_id", "_th", F.inline(F.concat("base", "weak"))).distinct()
    # access: identifier; id: identifier; assign, hex, key: secret
    role = F.when(F.col("kind").isin(1, 3), "identifier").when(F.col("kind").isin(0, 2, 4), "secret")
    bins = lambda start, end: F.sequence(F.floor(start / scope), F.floor(end / scope))
    near = parts.withColumn("role", role).where("role IS NOT NULL").select(
        "_id", "_th", F.col("start").alias("from"), F.col("end").alias("to"), "role", F.explode(bins(F.col("start"), F.col("end"))).alias("bin"))
    weak = parts.where(F.col("kind") >= 3).withColumn("bin", F.explode(bins(F.col("start") - scope, F.col("end") + scope)))
    first = F.floor(F.greatest(F.col("from"), F.col("start") - scope) / scope)
    beside = weak.join(near, ["_id", "_th", "bin"]).where(
        (F.col("from") <= F.col("end") + scope) & (F.col("to") >= F.col("start") - scope) & (F.col("bin") == first)
        & ((F.col("from") >= F.col("end")) | (F.col("to") <= F.col("start"))))  # what overlaps is the same string, no complement
    seen = beside.groupBy("_id", "_th", "start", "kind", "end").agg(
        F.max(F.col("role") == "identifier").alias("identifier"), F.max(F.col("role") == "secret").alias("secret"))
    good = F.when(F.col("kind") == 3, F.col("secret")).when(F.col("kind") == 4, F.col("identifier")).otherwise(F.col("identifier") & F.col("secret"))
    return seen.where(good).groupBy("_id", "_th").agg(F.collect_list(F.struct("start", "kind", "end")).alias("linked"))


def _joined(spans: Column) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _count(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """(id, n_assign, n_access, n_hex, base_sha256, spans) of every row."""
    found = materialize(_found(docs, id_col, text_col), "secrets")
    rows = found.join(link_parts(found, scope), ["_id", "_th"], "left")
    count = [_count(F.col("base"), k).alias(f"n_{KINDS[k]}") for k in range(3)]
    every = F.array_sort(F.concat("base", F.coalesce("linked", F.array().cast(_SPAN))))
    return rows.select(F.col("_doc").alias(id_col), *count, F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(every).alias("spans"))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """``docs`` with every span of the text replaced by ``[SECRET]``; overlapping spans become one."""
    columns = docs.columns
    linked = materialize(link_parts(materialize(_found(docs, id_col, text_col).where(F.size("weak") > 0), "secrets"), scope), "linked")
    keyed = docs.select(*(F.col(c).alias(f"_in_{i}") for i, c in enumerate(columns)), *doc_key(id_col, text_col))
    rows = keyed.join(linked, ["_id", "_th"], "left")
    text = F.col(f"_in_{columns.index(text_col)}")
    every = F.array_sort(F.concat(base_spans(F.coalesce(text, F.lit(""))), F.coalesce("linked", F.array().cast(_SPAN))))
    rows = rows.withColumn("_spans", every)
    between = "array<struct<from:int,to:int>>"

    def step(acc: Column, s: Column) -> Column:
        part = F.struct(acc["at"].alias("from"), s["start"].alias("to"))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                        F.when(s["start"] >= acc["at"], F.array_append(acc["out"], part)).otherwise(acc["out"]).alias("out"))

    def block(acc: Column, spans: Column) -> Column:
        inner = F.aggregate(spans, F.struct(acc["at"].alias("at"), F.array().cast(between).alias("out")), step)
        return _let(inner, lambda x: F.struct(x["at"].alias("at"), F.array_append(acc["out"], x["out"]).alias("out")))

    # what stays, up to each mask
    stays = F.aggregate(_blocks(F.col("_spans")), F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{between}>").alias("out")), block)
    masked = _let(stays, lambda x: F.concat(
        F.array_join(F.transform(F.flatten(x["out"]), lambda p: F.concat(F.substring(text, p["from"] + 1, p["to"] - p["from"]), F.lit(MASK))), ""),
        F.substring(text, x["at"] + 1, F.length(text))))
    changed = F.when(F.size("_spans") > 0, masked).otherwise(text)
    return rows.select(*((changed if c == text_col else F.col(f"_in_{i}")).alias(c) for i, c in enumerate(columns)))
