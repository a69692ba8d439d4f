"""Scalar column expressions (all JVM-side built-ins, no Python UDFs).

Each function takes and returns ``Column`` objects so it composes inside a
single projection and stays within whole-stage code generation.  ANSI mode
is on by default in Spark 4, so parsing uses ``try_*`` forms and array
access uses ``get`` (NULL instead of an error when out of range).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from recoflow import constants as C


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_of_date(as_of) -> Column:
    """``as_of`` as a DATE literal (accepts str or date)."""
    if isinstance(as_of, (_dt.date, _dt.datetime)):
        as_of = as_of.strftime("%Y-%m-%d")
    return F.to_date(F.lit(str(as_of)))


def midnight_epoch(as_of, days_back: int) -> Column:
    """Epoch seconds of midnight ``days_back`` days before ``as_of``."""
    return F.unix_timestamp(F.date_sub(as_of_date(as_of), days_back).cast("timestamp"))


def is_blank(c) -> Column:
    """NULL, empty, or whitespace only (Python ``not s.strip()``)."""
    c = col(c)
    return c.isNull() | ~c.rlike(r"\S")


def not_blank(c) -> Column:
    c = col(c)
    return c.isNotNull() & c.rlike(r"\S")


# -- 13 / 14: user id -------------------------------------------------------

def resolve_user_batch(user_id="sp_user_id", domain_id="sp_domain_userid") -> Column:
    """Batch rule: the logged-in user id unless NULL, else the domain id."""
    return F.coalesce(col(user_id), col(domain_id))


def resolve_user_stream(user_id="sp_user_id", domain_id="sp_domain_userid") -> Column:
    """Stream rule: the domain id wins when present; blanks count as missing."""
    d, u = col(domain_id), col(user_id)
    return F.when(not_blank(d), d).when(not_blank(u), u)


# -- 15 / 16: text to epoch seconds ----------------------------------------

def epoch_batch(c) -> Column:
    """ISO-8601 text to epoch seconds; unparsable text gives NULL."""
    return F.unix_timestamp(F.try_to_timestamp(col(c)))


def epoch_stream(c, ingest_time) -> Column:
    """Drop the last 5 characters (``.000Z``), parse as year-month-dayT
    hour:minute:second (UTC); unparsable text falls back to the ingest time
    (epoch seconds).  Single-letter fields accept one or two digits, as a
    ``%Y-%m-%dT%H:%M:%S`` strptime does."""
    c = col(c)
    head = F.substring(c, F.lit(1), F.length(c) - 5)
    parsed = F.unix_timestamp(F.try_to_timestamp(head, F.lit("yyyy-M-d'T'H:m:s")))
    return F.coalesce(parsed, col(ingest_time).cast("long"))


# -- 17 / 18: exclusion flag -----------------------------------------------

def exclude_flag_batch(sponsored="Sponsored", section="Section", keywords="Keywords") -> Column:
    """1 if sponsored, in the excluded section, or the joined keywords
    contain an excluded word as a substring; else 0."""
    joined = F.concat_ws("|", col(keywords))
    hit = (F.coalesce(col(sponsored) == 1, F.lit(False))
           | F.coalesce(col(section) == C.EXCLUDED_SECTION, F.lit(False)))
    for word in C.EXCLUDED_KEYWORDS:
        hit = hit | joined.contains(word)
    return F.when(hit, 1).otherwise(0)


def exclude_flag_stream(sponsored="Sponsored", section="Section", keywords="Keywords") -> Column:
    """Same rule with exact keyword elements; NULL keywords match nothing."""
    hit = (F.coalesce(col(sponsored) == F.lit(True), F.lit(False))
           | F.coalesce(col(section) == C.EXCLUDED_SECTION, F.lit(False)))
    for word in C.EXCLUDED_KEYWORDS:
        hit = hit | F.coalesce(F.array_contains(col(keywords), word), F.lit(False))
    return F.when(hit, 1).otherwise(0)


# -- 19: text cut ------------------------------------------------------------

def truncate_text(c, limit: int = C.CONTENT_TEXT_LIMIT) -> Column:
    return F.substring(col(c), 1, limit)


# -- 23: request limit --------------------------------------------------------

def parse_limit(c) -> Column:
    """Requested count: integer text, else the default; integers beyond the
    type count as its largest or smallest value."""
    text = col(c).cast("string")
    beyond = F.when(text.rlike(r"^\s*\+?\d+\s*$"), F.lit(2147483647)).when(
        text.rlike(r"^\s*-\d+\s*$"), F.lit(-2147483648))
    return F.coalesce(col(c).try_cast("int"), beyond, F.lit(C.DEFAULT_LIMIT))


def num_results(limit) -> Column:
    """Ask for one more than the limit (the current article may come back),
    never more than the service cap. Zero or a negative limit asks for no rows and gets an empty list."""
    return F.least(col(limit).cast("long") + 1, F.lit(C.MAX_RESULTS).cast("long")).cast("int")


# -- 24: category -------------------------------------------------------------

def section_category(section) -> Column:
    """Second ``/`` part of a section path; a path without ``/`` is used whole."""
    s = col(section)
    return F.when(F.instr(s, "/") > 0, F.split_part(s, F.lit("/"), F.lit(2))).otherwise(s)


def alias_category(c) -> Column:
    c = col(c)
    out = c
    for k, v in C.CATEGORY_ALIASES.items():
        out = F.when(c == k, F.lit(v)).otherwise(out)
    return out


def resolve_category(include_sections="include_sections", section="section") -> Column:
    """include_sections if non-empty, else from the section path, else the
    default category; then the alias map."""
    inc, sec = col(include_sections), col(section)
    raw = (F.when(F.length(inc) > 0, inc)
           .when(F.length(sec) > 0, section_category(sec))
           .otherwise(F.lit(C.DEFAULT_CATEGORY)))
    return alias_category(raw)


# -- 25: context values ----------------------------------------------------------

def capitalize(c) -> Column:
    """Python ``str.lower().capitalize()``: first character upper, rest lower;
    empty or NULL gives NULL (the field is then not sent)."""
    c = col(c)
    out = F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, F.lit(2), F.length(c))))
    return F.when(F.length(c) > 0, out)


# -- 27 / 28: reply shaping ------------------------------------------------------

def join_byline(c) -> Column:
    """List of names joined with `` and ``; an empty list gives ''."""
    c = col(c)
    return F.when(c.isNotNull(), F.array_join(c, " and "))


def first_url220(arr) -> Column:
    """``url220`` of the first element, '' when that element has none;
    NULL when the array is NULL or empty (nothing to copy)."""
    arr = col(arr)
    return F.when(F.size(arr) > 0, F.coalesce(F.get(arr, 0).getField("url220"), F.lit("")))


# -- 30: dated filter name ----------------------------------------------------------

def dated_filter_name(name, as_of) -> Column:
    """``<name>-<yesterday yyyy-MM-dd>``"""
    day = F.date_format(F.date_sub(as_of_date(as_of), 1), "yyyy-MM-dd")
    return F.concat(col(name), F.lit("-"), day)
