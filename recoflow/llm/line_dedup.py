"""Line dedup by winnowing, in DataFrame functions only.

The non-blank lines of a document are a sequence. In every window of
``run`` lines the line with the smallest hash is selected as fingerprint,
so two equal runs of that many lines are guaranteed to share one.
A first pass counts fingerprints over the corpus, by their positions; nothing else of it
is kept. A second pass keeps the windows whose fingerprint was selected at two
positions or more, with the fingerprint's place and the lines beside the window. Positions are
joined to the earliest one with the same window (one partner each, no pairs of all occurrences),
each match is extended both ways by the lines beside it that agree with the partner's, and what
touches makes up the longest runs. A run that stands earlier (smaller id, or same
document, earlier line) is deleted where it stands later; blank lines
inside it go with it, all others stay.

Runs of ``run`` lines are the rule of ``dedup_lines`` and of its SQL. On
demand (``words``) shorter runs count too, down to single lines, where they
have at least so many words: then every repeated run of that many words is
deleted, in however few lines it stands.

A window that many documents share is grouped once a document before it is shuffled.

Cases: null text has no lines and stays null. Null ids are the smallest.
Rows with the same id and text are one document; rows with one id and
different texts are different documents of which neither is earlier. Lines
end at a newline; of equally small hashes the first counts. An empty table gives no
rows. Columns but id and text are passed on unchanged by ``drop_repeated_lines``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, doc_key, materialize

RUN = 3
LONG = 20  # words from which a shorter run counts too, as many as a window of substring_dedup
_FILLED = r"[^\x20\x09-\x0D]"


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


_WINDOW = ("struct<run:int,start:int,first:int,last:int,fingerprint:bigint,place:int,low:bigint,high:bigint,"
           "before:struct<at:int,low:bigint,high:bigint>,after:struct<at:int,low:bigint,high:bigint>>")


def _windows(rows: DataFrame, run: int, words: int | None) -> DataFrame:
    """(_id, _th, windows): every window of ``run`` non-blank lines, and of fewer with so many words; a text is split once."""
    kept = F.filter(F.transform(_lines(F.col("_text")), lambda line, i: F.struct(i.alias("at"), line.alias("line"))),
                    lambda s: s["line"].rlike(_FILLED))
    count = (lambda line: F.regexp_count(line, F.lit(_FILLED + "+"))) if words else (lambda line: F.lit(0))
    hashed = F.transform(kept, lambda s: F.struct(
        s["at"].alias("at"), count(s["line"]).alias("words"), F.xxhash64(s["line"]).alias("low"), F.xxhash64(F.lit(1), s["line"]).alias("high")))
    lines = rows.select("_id", "_th", hashed.alias("kept")).withColumn("low", F.col("kept.low"))

    def beside(k: Column) -> Column:
        found = F.get("kept", k)
        return F.when(found.isNotNull(), F.struct(found["at"].alias("at"), found["low"].alias("low"), found["high"].alias("high")))

    def window(k: Column, size: int) -> Column:
        some = F.slice("low", k + 1, size)
        least, whole = F.array_min(some), F.slice("kept", k + 1, size)
        pairs = F.transform(whole, lambda s: F.struct(s["low"].alias("low"), s["high"].alias("high")))
        return F.struct(F.lit(size).alias("run"), k.alias("start"), F.get("kept", k)["at"].alias("first"), F.get("kept", k + size - 1)["at"].alias("last"),
                        least.alias("fingerprint"), (k + F.array_position(some, least) - 1).cast("int").alias("place"),
                        F.xxhash64(pairs).alias("low"), F.xxhash64(F.lit(1), pairs).alias("high"),
                        beside(k - 1).alias("before"), beside(k + size).alias("after")).cast(_WINDOW)

    def every(size: int) -> Column:
        starts = F.sequence(F.lit(0), F.size("kept") - size)
        if size < run:
            starts = F.filter(starts, lambda k: F.aggregate(F.slice("kept", k + 1, size), F.lit(0), lambda acc, s: acc + s["words"]) >= words)
        found = F.transform(starts, lambda k: window(k, size))
        return F.when(F.size("kept") >= size, found).otherwise(F.array().cast(f"array<{_WINDOW}>"))

    return lines.select("_id", "_th", F.concat(*(every(size) for size in range(1 if words else run, run + 1))).alias("windows"))


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", run: int = RUN, words: int | None = None) -> DataFrame:
    """(_id, _th, runs): per document the line intervals (a, b, inclusive) that stand earlier elsewhere."""
    windows = _windows(docs.select(*doc_key(id_col, text_col), F.col(text_col).alias("_text")), run, words)
    # the positions of fingerprints, each once, however many windows next to each other selected it
    def moved(w: Column, i: Column) -> Column:
        before = F.get("windows", i - 1)
        return (i == 0) | (before["place"] != w["place"]) | (before["run"] != w["run"])

    # "outer": without it Spark filters on the arrays first, and makes them anew for every use in the filter
    selected = windows.select(F.inline_outer(F.transform(F.filter("windows", moved), lambda w: F.struct(
        w["run"].alias("run"), w["fingerprint"].alias("fingerprint"))))).where("run IS NOT NULL")
    again = materialize(selected.groupBy("run", "fingerprint").agg(F.count("*").alias("times")).where("times > 1").select("run", "fingerprint"), "again")
    around = windows.select("_id", "_th", F.inline_outer("windows")).join(again, ["run", "fingerprint"])
    spans = materialize(around.groupBy("run", "low", "high", "_id", "_th").agg(
        F.sort_array(F.collect_set(F.struct("start", "first", "last", "before", "after"))).alias("spans")), "spans")
    earliest = spans.groupBy("run", "low", "high").agg(
        F.min(F.struct("_id", "_th", F.col("spans")[0].alias("span"))).alias("earliest"), F.count("*").alias("docs"), F.max(F.size("spans")).alias("most"))
    earliest = materialize(earliest.where("docs > 1 OR most > 1").select(
        "run", "low", "high", F.col("earliest._id").alias("first_id"), F.col("earliest.span").alias("first_span")), "earliest")
    # every later position with its partner: the earliest of all, or of its own document
    elsewhere = F.col("_id") > F.col("first_id")
    pairs = spans.join(earliest, ["run", "low", "high"]).select(
        "_id", "_th", F.when(elsewhere, F.col("first_span")).otherwise(F.col("spans")[0]).alias("p"),
        F.explode(F.when(elsewhere, F.col("spans")).otherwise(F.slice("spans", 2, F.size("spans")))).alias("s"))
    # a line beside the match that agrees with the partner's belongs to it, with the blank lines between
    def reaches(side: str, end: str) -> Column:
        mine, theirs = F.col(f"s.{side}"), F.col(f"p.{side}")
        return F.when((mine["low"] == theirs["low"]) & (mine["high"] == theirs["high"]), mine["at"]).otherwise(F.col(f"s.{end}"))

    gone = pairs.select("_id", "_th", reaches("before", "first").alias("a"), reaches("after", "last").alias("b"))
    # matches that touch are one run
    before = Window.partitionBy("_id", "_th").orderBy("a", "b").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("_id", "_th").orderBy("a", "b").rowsBetween(Window.unboundedPreceding, 0)
    opened = gone.withColumn("_before", F.max("b").over(before)).withColumn(
        "_new", (F.col("_before").isNull() | (F.col("a") > F.col("_before"))).cast("int"))
    runs = opened.withColumn("_run", F.sum("_new").over(upto)).groupBy("_id", "_th", "_run").agg(F.min("a").alias("a"), F.max("b").alias("b"))
    out = materialize(runs.groupBy("_id", "_th").agg(F.sort_array(F.collect_list(F.struct("a", "b"))).alias("runs")), "runs")
    for done in (again, spans, earliest):
        discard(done)
    return out


def _cut(text: Column, runs: Column) -> Column:
    """The text without the lines of ``runs``: the slices between them, joined again."""
    lines = _lines(text)
    begin = lambda j: F.when(j == 0, F.lit(0)).otherwise(F.element_at(runs, F.greatest(j, F.lit(1)))["b"] + 1)
    end = lambda j: F.when(j == F.size(runs), F.size(lines)).otherwise(F.element_at(runs, F.least(j + 1, F.size(runs)))["a"])
    left = F.flatten(F.transform(F.sequence(F.lit(0), F.size(runs)), lambda j: F.slice(lines, begin(j) + 1, end(j) - begin(j))))
    return F.when(runs.isNull(), text).otherwise(F.array_join(left, "\n"))


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", run: int = RUN, words: int | None = None) -> DataFrame:
    """``docs`` with later repeated runs of lines deleted from the text; all rows and columns stay."""
    columns = docs.columns
    runs = repeated_runs(docs, id_col, text_col, run, words)
    keyed = docs.select(*(F.col(c).alias(f"_in_{i}") for i, c in enumerate(columns)), *doc_key(id_col, text_col))
    rows = keyed.join(runs.hint("merge"), ["_id", "_th"], "left")  # one plan at every size
    return rows.select(*((_cut(F.col(f"_in_{i}"), F.col("runs")) if c == text_col else F.col(f"_in_{i}")).alias(c) for i, c in enumerate(columns)))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", run: int = RUN, words: int | None = None) -> DataFrame:
    """(id, n_lines, n_removed, kept_sha256) of every row; null text: no lines, the hash of nothing."""
    rows = docs.select(*doc_key(id_col, text_col), F.col(id_col).alias("_doc"), F.col(text_col).alias("_text"))
    rows = rows.join(repeated_runs(docs, id_col, text_col, run, words).hint("merge"), ["_id", "_th"], "left")  # one plan at every size
    removed = F.aggregate(F.coalesce("runs", F.array().cast("array<struct<a:int,b:int>>")), F.lit(0), lambda acc, r: acc + r["b"] - r["a"] + 1)
    return rows.select(
        F.col("_doc").alias(id_col), F.coalesce(F.size(_lines(F.col("_text"))), F.lit(0)).cast("long").alias("n_lines"),
        removed.cast("long").alias("n_removed"), F.sha2(F.coalesce(_cut(F.col("_text"), F.col("runs")), F.lit("")), 256).alias("kept_sha256"))
