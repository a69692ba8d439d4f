"""Property tests: column functions against a plain-Python statement of each
rule, on random inputs (one Spark job per example batch)."""

from __future__ import annotations

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from recoflow import constants as C
from recoflow.functions import columns as fn

SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

TEXT = st.text(alphabet="ab/-Xy z", max_size=12)
MAYBE = st.one_of(st.none(), TEXT, st.sampled_from(sorted(C.CATEGORY_ALIASES)))


def spec_category(inc, sec):
    if inc:
        c = inc
    elif sec:
        c = sec.split("/")[1] if "/" in sec else sec
    else:
        c = C.DEFAULT_CATEGORY
    return C.CATEGORY_ALIASES.get(c, c)


def spec_capitalize(s):
    return s.lower().capitalize() if s else None


def spec_epoch_stream(s, now):
    try:
        t = dt.datetime.strptime(s[:-5], "%Y-%m-%dT%H:%M:%S")
        return int(t.replace(tzinfo=dt.timezone.utc).timestamp())
    except (ValueError, TypeError):
        return now


def spec_exclude_stream(sponsored, section, keywords):
    kw = keywords or []
    return int(sponsored is True or section == C.EXCLUDED_SECTION
               or any(w in kw for w in C.EXCLUDED_KEYWORDS))


def spec_exclude_batch(sponsored, section, keywords):
    joined = "|".join(keywords or [])
    return int(sponsored == 1 or section == C.EXCLUDED_SECTION
               or any(w in joined for w in C.EXCLUDED_KEYWORDS))


def spec_limit(s):
    try:
        return int(s)
    except (ValueError, TypeError):
        return C.DEFAULT_LIMIT


def _col(spark, ddl, data, *exprs):
    df = spark.createDataFrame(data, ddl)
    return [tuple(r) for r in df.select(*[e.alias(f"c{i}") for i, e in enumerate(exprs)]).collect()]


@SETTINGS
@given(st.lists(st.tuples(MAYBE, MAYBE), min_size=1, max_size=20))
def test_category_rule(spark, data):
    got = _col(spark, "include_sections string, section string", data, fn.resolve_category())
    assert [g[0] for g in got] == [spec_category(i, s) for i, s in data]


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aBcD Mé", max_size=8)), min_size=1,
                max_size=20))
def test_capitalize_rule(spark, data):
    got = _col(spark, "p string", [(x,) for x in data], fn.capitalize("p"))
    assert [g[0] for g in got] == [spec_capitalize(x) for x in data]


DATES = st.datetimes(min_value=dt.datetime(2000, 1, 1), max_value=dt.datetime(2030, 12, 31))
STAMPS = st.one_of(
    DATES.map(lambda t: t.strftime("%Y-%m-%dT%H:%M:%S") + ".000Z"),
    DATES.map(lambda t: f"{t.year}-{t.month}-{t.day}T{t.hour}:{t.minute}:{t.second}.123Z"),
    st.text(alphabet="0123456789-T:.Z", max_size=24))


@SETTINGS
@given(st.lists(STAMPS, min_size=1, max_size=20))
def test_epoch_stream_rule(spark, data):
    got = _col(spark, "t string", [(x,) for x in data], fn.epoch_stream("t", F.lit(7)))
    assert [g[0] for g in got] == [spec_epoch_stream(x, 7) for x in data]


KW = st.one_of(st.none(), st.lists(st.sampled_from(["omit", "omitted", "zerocanada", "x", "climate"]),
                                   max_size=3))


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), st.booleans()),
                          st.one_of(st.none(), st.sampled_from(["news", C.EXCLUDED_SECTION])), KW),
                min_size=1, max_size=20))
def test_exclude_rules(spark, data):
    got = _col(spark, "Sponsored boolean, Section string, Keywords array<string>", data,
               fn.exclude_flag_stream())
    assert [g[0] for g in got] == [spec_exclude_stream(*d) for d in data]
    batch = [(None if s is None else int(s), sec, kw) for s, sec, kw in data]
    got = _col(spark, "Sponsored int, Section string, Keywords array<string>", batch,
               fn.exclude_flag_batch())
    assert [g[0] for g in got] == [spec_exclude_batch(*d) for d in batch]


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.integers(-5, 900).map(str),
                          st.text(alphabet="12x. ", max_size=4)), min_size=1, max_size=20))
def test_limit_rule(spark, data):
    got = _col(spark, "l string", [(x,) for x in data], fn.parse_limit("l"),
               fn.num_results(fn.parse_limit("l")))
    want = [(spec_limit(x), min(spec_limit(x) + 1, C.MAX_RESULTS)) for x in data]
    assert got == want
