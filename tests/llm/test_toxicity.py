"""The clause grammar against a plain reading of its rules; the learned model by held-out accuracy."""

from __future__ import annotations

import random
import re
import zlib

import numpy as np
import pytest

from recoflow.llm import queries, toxicity

LEXICON = toxicity.Lexicon({"idiot$": True, "lowei": True, "clown$": False})


def plain_counts(text: str) -> list[int]:
    """Rule by rule, clause by clause, looking at all words before a match."""
    kinds = dict.fromkeys(toxicity.KINDS, 0)
    for clause in re.split("[.!?;\n]", text.lower()):
        words = [w.replace("’", "'") for w in re.findall(r"[^\W\d_]+(?:['’][^\W\d_]+)?|[\"«»„“”]", clause)]

        def hit(w):
            stems = {s: "T" for s in toxicity.THREATS} | {"idiot$": "I", "lowei": "I", "clown$": "J"}
            return next((v for s, v in stems.items() if (w == s[:-1] if s.endswith("$") else w.startswith(s))), None)

        if not any(hit(w) for w in words):
            continue
        waiting, named = None, False
        for i, w in enumerate(words):
            letter = hit(w)
            if letter:
                quotes = sum(x in "\"«»„“”" for x in words[:i])
                if any(x in toxicity.NEGATIONS and not hit(x) for x in words[max(0, i - 3): i]):
                    kinds[letter + "n"] += 1
                elif quotes % 2 or any(x in toxicity.SAYING for x in words[:i]):
                    kinds[letter + "r"] += 1
                elif named:
                    kinds[letter + "y"] += 1
                else:
                    kinds[letter + "p"] += 1
                    waiting = letter
            elif w in toxicity.TARGETS:
                if waiting:
                    kinds[waiting + "l"] += 1
                waiting, named = None, True
    return list(kinds.values())


def test_grammar_by_hand():
    built = LEXICON.build()
    read = lambda text: {k: n for k, n in zip(toxicity.KINDS, toxicity.count_kinds(text, built) or []) if n}
    assert read("You are an IDIOT!! Really.") == {"Iy": 1}
    assert read("idiot, he is") == {"Ip": 1, "Il": 1}
    assert read("He is not an idiot") == {"In": 1}
    assert read('She said "idiot" twice') == {"Ir": 1}
    assert read("I will kill you. You: clown") == {"Tp": 1, "Tl": 1, "Jy": 1}
    assert read("no. idiot") == {"Ip": 1}
    assert read("loweischaft") == {"Ip": 1} and read("idiotic xidiot x_idiot1") == {"Ip": 1}
    assert read("") == {} and read("nothing here, you") == {}


def test_grammar_on_random_clauses():
    rng, built = random.Random(4), LEXICON.build()
    words = ["idiot", "Loweiß", "clown", "kill", "you", "er", "not", "don’t", "said", '"', "the", "xx", "é", "idiots", ".", "\n", ",", "%%%"]
    for _ in range(3000):
        text = " ".join(rng.choice(words) for _ in range(rng.randint(0, 25)))
        assert (toxicity.count_kinds(text, built) or [0] * len(toxicity.KINDS)) == plain_counts(text)


def test_a_long_text_is_read_in_time():
    built = LEXICON.build()
    assert toxicity.count_kinds("idiot " * 200_000, built)[0] == 200_000
    assert toxicity.count_kinds("idiot.\n" * 200_000, built)[0] == 200_000


def corpus(n: int):
    """Neutral words, insults from a hidden list in some, with inflected ones, copies, and labels with nulls."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))
    insults = ["zorb", "quix", "vlam"]
    docs, labels = [], []
    for i in range(n):
        toxic = rng.random() < 0.15
        words = [word() for _ in range(rng.randint(5, 80))]
        for _ in range(rng.randint(1, 4) if toxic else 0):
            words.insert(rng.randint(0, len(words)), rng.choice(insults) + rng.choice(["", "en", "ista", "!"]))
        text = " ".join(words)
        if toxic and rng.random() < 0.1 or i == 7:
            text, toxic = docs[-1][1], labels[-1][1]
        docs.append((i, text))
        labels.append((i, int(toxic)))
    docs += [(None, "zorb"), (n, None), (n + 1, ""), (0, docs[0][1]), (n + 2, "zorbista vlam quix!")]
    labels += [(0, labels[0][1]), (None, 1), (1, None), (n + 50, 1)]
    return docs, labels


@pytest.fixture(scope="module")
def tables(spark):
    docs, labels = corpus(900)
    return (spark.createDataFrame([(*d, "x", "y", 1, 2) for d in docs], "doc_id long, text string, lang string, toxic string, kinds int, _text int").repartition(4),
            spark.createDataFrame([(d, t, 0) for d, t in labels], "doc_id long, toxic int, quality int"))


def _op11(monkeypatch, spark, docs, labels):
    monkeypatch.setattr(queries, "_table", lambda s, d, name: docs if name == "documents" else labels)
    return queries.op11_toxicity(spark, "").select("doc_id", "held_out", "score", "predicted").collect()


def test_held_out_accuracy(spark, tables, monkeypatch):
    rows = _op11(monkeypatch, spark, *tables)
    docs, labels = corpus(900)
    truth = {d: t for d, t in labels if t is not None}
    assert len(rows) == len(docs)
    for r in rows:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    unseen = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    caught = sum(p and t for p, t in unseen) / sum(t for _, t in unseen)
    false = sum(p and not t for p, t in unseen) / sum(not t for _, t in unseen)
    assert len(unseen) > 150 and caught > 0.95 and false < 0.01
    by_id = {r.doc_id: r for r in rows}
    assert by_id[902].predicted == 1 and by_id[900].score == by_id[901].score < 0.3 and by_id[None].predicted == 1


def test_held_out_labels_are_never_read(spark, tables, monkeypatch):
    docs, labels = tables
    turned = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(doc_id AS STRING)) % 4 = 2 THEN 1 - toxic ELSE toxic END AS toxic", "quality")
    key = lambda r: (r.doc_id is not None, r.doc_id, r.score)
    assert sorted(_op11(monkeypatch, spark, docs, labels), key=key) == sorted(_op11(monkeypatch, spark, docs, turned), key=key)


def test_without_labels_or_documents(spark, tables, monkeypatch):
    docs, labels = tables
    assert {r.predicted for r in _op11(monkeypatch, spark, docs, labels.where("false"))} == {0}
    assert _op11(monkeypatch, spark, docs.where("false"), labels) == []


def test_weights_have_the_least_loss_of_those_not_below_zero():
    rng = np.random.default_rng(3)
    counts = rng.integers(0, 3, (400, len(toxicity.KINDS)))
    toxic = (rng.random(400) < 1 / (1 + np.exp(2 - counts[:, 0] * 2))).astype(float)
    w = toxicity.fit_weights(counts.astype(float), toxic)

    def loss(v):
        z = np.log1p(counts) @ v[1:] + v[0]
        prior = toxicity._prior()
        return np.sum(np.logaddexp(0, z) - toxic * z) + 0.25 * np.sum((v[1:] - prior[1:]) ** 2) + 0.0005 * (v[0] - prior[0]) ** 2
    for i in range(len(w)):
        for step in (-1e-2, 1e-2):
            moved = w.copy()
            moved[i] += step
            assert loss(moved) >= loss(w) - 1e-9 or (i and moved[i] < 0)


def test_copies_do_not_make_stems():
    """Forty copies of one document weigh as one: its words are no stems, words of several documents are."""
    own = {f"w{i}$": (list(range(40)), 0) for i in range(20)}
    spread = {"bad$": ([*range(40), *range(40, 60)], 0)}
    weights = toxicity.copy_weights([(1, 2, 3)] * 40 + [(i, i, i) for i in range(50, 80)])
    assert set(toxicity.choose_stems(own | spread, weights, 100)) == {"bad$"}
