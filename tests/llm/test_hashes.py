"""Words and lines whose polynomial hashes modulo 2**64 agree whatever the multiplier: no operator may confuse them."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from recoflow.llm import jaccard_join, lm_score, quality, secret_scan, substring_dedup
from recoflow.llm.textscan import Words, run_hashes

MORSE = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
OTHER = MORSE.translate(str.maketrans("ab", "ba"))


def _docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_run_hashes_follow_the_bytes():
    rng = random.Random(6)
    words = list({"".join(rng.choice("ab\0é") for _ in range(rng.randint(1, 40))) for _ in range(20_000)} | {MORSE, OTHER, MORSE + "a", "a" * 16, "a" * 24})
    data = "".join(words).encode()
    ends = np.cumsum([len(w.encode()) for w in words])
    starts = np.append(0, ends[:-1])
    for family in (0, 1):
        found = run_hashes(np.frombuffer(data, np.uint8), starts, ends, family)
        assert len(set(found.tolist())) == len(words)
        again = run_hashes(np.frombuffer(b"xyz" + data, np.uint8), starts + 3, ends + 3, family)
        assert (found == again).all()  # wherever they stand
    assert (run_hashes(np.frombuffer(data, np.uint8), starts, ends, 0) != found).all()
    assert len(Words(pa.array(["", " \n"], pa.large_string())).hashes()) == 0


def test_substring_dedup_tells_them_apart(spark):
    common = " ".join(f"w{i}" for i in range(19))
    rows = [(1, f"{common} {MORSE}"), (2, f"{common} {OTHER}"), (3, f"{common} {MORSE}")]
    found = {r.doc_id: r.n_removed for r in substring_dedup.dedup_substrings(_docs(spark, rows), cells=1 << 12).collect()}
    assert found == {1: 0, 2: 0, 3: 20}


def test_quality_tells_them_apart(spark):
    words = " ".join(f"x{i}" for i in range(12))
    five = lambda w: f"{w} one two three four"
    rows = [(1, f"{words}\n{MORSE}\n{OTHER}"), (2, f"{words}\n{MORSE}\n{MORSE}"), (3, f"{words} {five(MORSE)} {five(OTHER)}"), (4, f"{words} {five(MORSE)} {five(MORSE)}")]
    docs = _docs(spark, rows)
    found = {r.doc_id: (r.n_dup_lines, r.n_repeat_words) for r in quality.judge_documents(docs, quality.Model(np.zeros(quality.BUCKETS), 0.0)).collect()}
    assert found == {1: (0, 0), 2: (1, 0), 3: (0, 0), 4: (0, 10)}


def test_lm_tells_them_apart(spark):
    rows = [(0, MORSE), (2, OTHER), (4, f"{OTHER} {OTHER}")]
    assert [r.n_known for r in lm_score.score_documents(_docs(spark, rows)).collect()]
    import zlib
    train = [t for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2]
    known = {w for t in train for w in t.split()}
    for r in lm_score.score_documents(_docs(spark, rows + [(6, MORSE + "b"), (7, OTHER)])).collect():
        if r.doc_id in (0, 2, 4):
            text = dict(rows)[r.doc_id]
            more = known | {w for i, w in ((6, MORSE + "b"), (7, OTHER)) if zlib.crc32(str(i).encode()) % 7 != 2}
            assert r.n_known == sum(w in more for w in text.split()) + 1


def test_jaccard_tells_them_apart(spark):
    words = "p q r s"
    rows = [(1, f"{words} {MORSE} t"), (2, f"{words} {OTHER} t"), (3, f"{words} {MORSE} t")]
    found = {r.doc_id: (r.class_id, r.n_links) for r in jaccard_join.jaccard_join(_docs(spark, rows)).collect()}
    assert found[2] == (2, 0) and found[3] == (1, 1)


def test_a_quality_score_does_not_depend_on_neighbours(spark):
    rng = random.Random(7)
    rows = [(i, " ".join(rng.choice(["alpha", "beta", "gamma!", "éß"]) for _ in range(rng.randint(1, 300)))) for i in range(200)]
    model = quality.Model(np.random.default_rng(1).normal(size=quality.BUCKETS), 0.0)
    scores = lambda docs: {r.doc_id: r.score for r in quality.judge_documents(docs, model).collect()}
    assert scores(_docs(spark, rows).coalesce(1)) == scores(_docs(spark, rows[::-1]).repartition(50))


def test_the_threshold_needs_something_to_reject():
    import pandas as pd
    bins = pd.DataFrame({"q": [1, 1, 0], "bin": [5, 9, 7], "count": [1, 999, 3]})
    assert quality.pick_threshold(bins, 0.995) == pytest.approx(9 / quality._BINS_PER_UNIT)
    assert quality.pick_threshold(bins.assign(bin=[5, 9, 10]), 0.995) == -np.inf


def test_a_string_does_not_complement_itself(spark):
    key = "aB3dE5gH7jK9mN1pQ3sT5vW7"
    rows = [(1, f"user: {key}"), (2, "user: 0123456789abcdef01234567"), (3, f"user: bob7 {key}")]
    found = {r.doc_id: r.spans for r in secret_scan.secret_spans(_docs(spark, rows)).collect()}
    assert found[1] == "" and found[2] == "hex:6:30" and found[3] == f"id:0:10,key:11:{11 + len(key)}"


def test_secrets_in_a_text_of_many_matches(spark):
    """Places and masks of 50,000 matches, found in a time that follows the matches."""
    import re
    n = 50_000
    text = "".join(f"é token=abc{k:06d} " for k in range(n))
    docs = _docs(spark, [(1, text), (2, "token=abcdef" * 3), (3, "x"), (4, "token=abcdef  token=ab password: 'hunter2x'")])
    found = {r.doc_id: r for r in secret_scan.secret_spans(docs).collect()}
    assert found[1].n_assign == n
    assert found[1].spans == ",".join(f"assign:{m.start()}:{m.end()}" for m in re.finditer(r"token=\w+", text))
    masked = {r.doc_id: r.text for r in secret_scan.redact(docs).collect()}
    assert masked[1] == f"é {secret_scan.MASK} " * n and masked[3] == "x"
    assert masked[4] == f"{secret_scan.MASK}  token=ab {secret_scan.MASK}'"
