"""Toxicity by a weighted finite-state grammar over clauses.

A clause is a stretch of text between ``. ! ? ;`` and newlines. Five
machines read it, composed into one:

* insults and threats: a character automaton over word stems (insult stems
  are learned, threat stems are given) turns words into symbols;
* negation: rewrites an insult or threat within three words after a negation;
* reported speech: rewrites one after a verb of saying, or inside quotation marks;
* targets: pairs an insult or threat with a person addressed or spoken of in
  the same clause, before or after it;
* the scorer: counts what is left by kind.

The kinds of matches (plain, targeted, negated, reported; strong, weak) are the
features of a logistic model; isolated words are no features. A clause without
an insult or threat is never read by the composed machine, as it scores nothing.

Learning. From at most ``SAMPLE_ROWS`` labelled documents (smallest hashes of
ids; those held out never): stems are beginnings of words (or whole words)
that toxic documents hold far more often than clean ones, chosen one by
one by the documents they explain (copies weigh as one document, so that their
words do not become stems); then the model's weights, by Newton's method with a
normal prior around ``PRIOR``. All documents are scored whole.

Cases: null and empty texts match nothing and get the score of such texts.
A null id is not held out and has no label. Documents of one id share its label;
repeated labels: the largest counts. Without labels of both kinds no stems are
learned and the prior scores. An empty table gives no rows. Ties between stems go to
the longer, then the smaller one. Only id and text are read from documents.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize

SAMPLE_ROWS = 40_000     # labelled documents that stems and weights are learned from, at most
LIFT = 20.0              # how much likelier a stem is in toxic documents, at least
STRONG = 100.0           # from this lift on a stem is strong
SHORTEST, LONGEST = 3, 9  # letters of a stem that is the beginning of longer words
FADE = 0.7               # worth of a document to further stems, for each stem that it holds
THRESHOLD = 0.3

# Word lists of the grammar, as stems of lower-case words ("$": the whole word).
THREATS = ("kill", "murder", "strangl", "punch", "stab$", "shoot$", "hang$", "umbring", "töten$", "verprügel", "erschieß", "tuer$", "étrangl",
           "frapper$", "matar", "golpear", "degoll")
TARGETS = frozenset("you your yours yourself u he him his she her they them their these those du dich dir dein deine ihr euch sie tu te toi ton vous votre "
                    "il elle ils elles tú ti vos usted ustedes él ella ellos ellas".split())
NEGATIONS = frozenset("not no never isn't aren't wasn't don't doesn't didn't won't nicht kein keine keinen nie niemals pas jamais aucun nunca jamás tampoco ni".split())
SAYING = frozenset("said says say called calls wrote writes quoted quote claimed reported sagte sagt nannte schrieb dit disait écrit appelé dijo dice llamó escribió".split())

# Symbols. Upper case: strong insult I, weak insult J, threat T; Y target, X negation, S saying, Q quotation mark, _ another word.
_WORDS = "IJTYXSQ_"
_HITS = ("I", "J", "T")
SCOPE = 3
#: Kinds of matches: hit letter and how it stands (p plain, y targeted, n negated, r reported); Iy+ etc.: a plain hit whose target comes later.
KINDS = [h + how for h in _HITS for how in "pynr"] + [h + "l" for h in _HITS]
#: Mean of the weights before any label is seen: the bias, then a weight per kind.
PRIOR_BIAS = -3.0
PRIOR = {"p": 1.5, "y": 2.0, "n": 0.2, "r": 0.3, "l": 0.5}
PRIOR_SCALE = {"I": 1.0, "J": 0.5, "T": 0.8}
_PENALTY = 0.5           # precision of the prior


class Machine:
    """A sequential transducer: one output symbol for each input symbol; states are 0 (start) upwards."""

    def __init__(self, states: int, step) -> None:
        self.states, self.step = states, step  # step(state, symbol) -> (state, symbol)


def compose(first: Machine, second: Machine) -> Machine:
    """The machine that feeds what ``first`` writes to ``second``."""
    def step(state: int, symbol: str) -> tuple[int, str]:
        a, b = divmod(state, second.states)
        a, middle = first.step(a, symbol)
        b, out = second.step(b, middle)
        return a * second.states + b, out
    return Machine(first.states * second.states, step)


def _negation(state: int, symbol: str) -> tuple[int, str]:
    if symbol == "X":
        return SCOPE, "_"
    return max(0, state - 1), symbol + "n" if state and symbol in _HITS else symbol


def _reporting(state: int, symbol: str) -> tuple[int, str]:
    if symbol == "S":
        return state | 1, "_"  # until the clause ends
    if symbol == "Q":
        return state ^ 2, "_"
    return state, symbol + "r" if state and symbol in _HITS else symbol


def _targeting(state: int, symbol: str) -> tuple[int, str]:
    """State 0: nothing; 1: a target was named; 2 to 4: a hit (of _HITS) still lacks one."""
    if symbol == "Y":
        return 1, _HITS[state - 2] + "l" if state > 1 else "_"
    if symbol in _HITS:
        return (state, symbol + "y") if state == 1 else (2 + _HITS.index(symbol), symbol + "p")
    return state, symbol


@lru_cache(maxsize=1)
def grammar() -> dict[tuple[int, str], tuple[int, int]]:
    """(state, word symbol) -> (state, kind or -1) of the composed machine, for all states that can be reached."""
    whole = compose(compose(Machine(SCOPE + 1, _negation), Machine(4, _reporting)), Machine(5, _targeting))
    table, todo = {}, [0]
    number = {k: i for i, k in enumerate(KINDS)}
    while todo:
        state = todo.pop()
        for symbol in _WORDS:
            if (state, symbol) not in table:
                after, out = whole.step(state, symbol)
                table[state, symbol] = after, number.get(out, -1)
                todo.append(after)
    return table


@dataclass
class Lexicon:
    """Insult stems: stem -> strong (bool); a stem that ends in $ is a whole word."""

    insults: dict[str, bool] = field(default_factory=dict)

    def build(self) -> tuple:
        symbols = {s: "T" for s in THREATS} | {s: "I" if strong else "J" for s, strong in self.insults.items()}
        whole = {s[:-1]: v for s, v in symbols.items() if s.endswith("$")}
        starts = {s: v for s, v in symbols.items() if not s.endswith("$")}
        automaton = ahocorasick.Automaton()
        for s in {*whole, *starts}:
            automaton.add_word(s, len(s))
        automaton.make_automaton()
        return automaton, whole, starts, sorted({len(s) for s in starts})


_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?|[\"«»„“”]")
_CLAUSE_END = re.compile(r"[.!?;\n]")


def _symbol(word: str, whole: dict[str, str], starts: dict[str, str], sizes: list[int]) -> str:
    if word in whole:
        return whole[word]
    for size in sizes:
        if word[:size] in starts:
            return starts[word[:size]]
    if word in TARGETS:
        return "Y"
    if word in NEGATIONS:
        return "X"
    if word in SAYING:
        return "S"
    return "Q" if word in "\"«»„“”" else "_"


def count_kinds(text: str, built: tuple) -> list[int] | None:
    """How many matches of each kind the clauses of a text hold; None if none."""
    automaton, whole, starts, sizes = built
    low = text.lower()
    counts, table, end = None, grammar(), -1
    for last, size in automaton.iter(low):
        at = last - size + 1
        if at < end or (at and low[at - 1].isalpha()):
            continue  # read already, or inside a word
        begin = max(low.rfind(x, max(0, end), at) for x in ".!?;\n") + 1 or max(0, end)
        found = _CLAUSE_END.search(low, last + 1)
        end = found.start() if found else len(low)
        state = 0
        for word in _WORD.findall(low[begin:end]):
            symbol = _symbol(word.replace("’", "'"), whole, starts, sizes)
            if symbol != "_" or state:
                state, kind = table[state, symbol]
                if kind >= 0:
                    counts = counts or [0] * len(KINDS)
                    counts[kind] += 1
    return counts


def word_stems(text: str) -> set[str]:
    """Beginnings of ``SHORTEST`` to ``LONGEST`` letters and whole words (with $) of a text."""
    out = set()
    for word in set(_WORD.findall(text.lower())):
        if len(word) >= SHORTEST:
            out.add(word + "$")
            out.update(word[:k] for k in range(SHORTEST, min(len(word) - 1, LONGEST) + 1))
    return out


def signature(text: str) -> list[int]:
    """Three min-hashes of the text's runs of three words."""
    words = text.lower().split()
    runs = {" ".join(words[i: i + 3]).encode() for i in range(max(1, len(words) - 2))}
    return [min(zlib.crc32(r, seed) for r in runs) for seed in (1, 2, 3)]


@dataclass
class Model:
    lexicon: Lexicon
    bias: float
    weights: np.ndarray

    def scores(self, counts: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.bias + np.log1p(counts) @ self.weights)))


def _prior() -> np.ndarray:
    return np.array([PRIOR_BIAS, *(PRIOR[k[1]] * PRIOR_SCALE[k[0]] for k in KINDS)])


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def copy_weights(signatures: list[tuple[int, ...]]) -> np.ndarray:
    """A document's weight: one over the number of documents that share one of its signatures, so that copies weigh as one."""
    weights = np.ones(len(signatures))
    for k in range(len(signatures[0]) if signatures else 0):
        sizes = Counter(s[k] for s in signatures)
        weights = np.minimum(weights, [1 / sizes[s[k]] for s in signatures])
    return weights


def choose_stems(stems: dict[str, tuple[list[int], int]], weights: np.ndarray, clean: int) -> dict[str, bool]:
    """stem -> strong. ``stems``: stem -> (toxic documents that hold it, number of clean ones); ``weights`` of the toxic documents.

    Greedy cover: a document counts less with each chosen stem that it holds, and nothing if that is
    a beginning or a continuation of the stem; a clean one costs two. Stems are taken while they gain enough.
    """
    toxic = len(weights)
    worth = weights.copy()
    held = {s: np.array(docs) for s, (docs, _) in stems.items()}
    least = max(2.0, 0.002 * weights.sum())

    def gain(s: str, done: list[str]) -> float:
        own = s.rstrip("$")
        kin = [held[x] for x in done if x.startswith(own) or (not x.endswith("$") and own.startswith(x))]
        docs = np.setdiff1d(held[s], np.concatenate(kin)) if kin else held[s]
        return worth[docs].sum() - 2 * stems[s][1]

    gains = {s: gain(s, []) for s in held}
    chosen: dict[str, bool] = {}
    while gains:
        best = max(gains, key=lambda s: (round(gains[s], 9), len(s), s))
        now = gain(best, list(chosen))
        if now < least:
            del gains[best]
        elif now < gains[best] - 1e-9:
            gains[best] = now
        else:
            del gains[best]
            docs, others = stems[best]
            chosen[best] = _lift(len(docs), others, toxic, clean) >= STRONG
            worth[held[best]] *= FADE
    return chosen


def _lift(c: int, k: int, toxic: int, clean: int) -> float:
    return ((c + 0.5) / (toxic + 1)) / ((k + 0.5) / (clean + 1))


def fit_weights(counts: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Bias and weights of largest posterior, by projected Newton steps; no weight is below 0, as no match makes a text less toxic."""
    x = np.column_stack([np.ones(len(counts)), np.log1p(counts)])
    prior = _prior()
    w = prior.copy()
    penalty = np.full(len(w), _PENALTY)
    penalty[0] = 1e-3

    def loss(v: np.ndarray) -> float:
        z = x @ v
        return float(np.sum(np.logaddexp(0, z) - toxic * z) + np.sum(penalty * (v - prior) ** 2) / 2)

    now = loss(w)
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        gradient = x.T @ (toxic - p) - penalty * (w - prior)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        free = (w > 0) | (gradient > 0)
        free[0] = True
        step = np.zeros(len(w))
        step[free] = np.linalg.solve(hessian[np.ix_(free, free)], gradient[free])
        size = 1.0
        while size > 1e-9:
            new = w + size * step
            new[1:] = np.maximum(new[1:], 0)
            if (then := loss(new)) <= now:
                break
            size /= 2
        else:
            break
        done, w, now = now - then < 1e-10, new, then
        if done:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Learn stems and weights from a bounded sample of the labelled documents that are not held out."""
    spark = docs.sparkSession
    rated = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out()).groupBy(
        F.col("doc_id").cast("long").alias("id")).agg((F.max("toxic") > 0).alias("toxic"))
    sample = rated.orderBy(F.xxhash64("id"), "id").limit(sample_rows).toPandas()
    known = spark.sparkContext.broadcast((np.sort(sample.id[sample.toxic].to_numpy(np.int64)), np.sort(sample.id[~sample.toxic].to_numpy(np.int64))))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            toxic, clean = np.isin(ids, known.value[0]), np.isin(ids, known.value[1])
            keep = np.flatnonzero(toxic | clean)
            yield pa.RecordBatch.from_arrays([pa.array(ids[keep]), pa.array(toxic[keep]), batch.column(1).take(pa.array(keep)).cast(pa.string())],
                                             names=["id", "toxic", "text"])

    texts = materialize(docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
                        .mapInArrow(pick, "id long, toxic boolean, text string"), "toxicity-sample")
    numbers = texts.groupBy("toxic").count().collect()
    toxic = sum(r["count"] for r in numbers if r.toxic)
    clean = sum(r["count"] for r in numbers if not r.toxic)
    if not toxic or not clean:
        discard(texts)
        return Model(Lexicon(), _prior()[0], _prior()[1:])
    least = max(3, int(0.002 * toxic))

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter, Counter] = Counter(), Counter()
        for batch in batches:
            for bad, text in zip(batch.column("toxic").to_pylist(), batch.column("text").to_pylist()):
                seen[bad].update(word_stems(text))
            if len(seen[0]) + len(seen[1]) > 1_000_000:
                yield _tallied(seen)
        yield _tallied(seen)

    both = texts.mapInArrow(tally, "stem string, bad long, good long").groupBy("stem").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    lift = (F.col("bad") + 0.5) / (toxic + 1) / ((F.col("good") + 0.5) / (clean + 1))
    stems = both.where((F.col("bad") >= least) & (lift >= LIFT)).toPandas()  # bounded by the sample's words
    good = dict(zip(stems.stem, stems.good))
    wanted = spark.sparkContext.broadcast({s: i for i, s in enumerate(stems.stem)})

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = [wanted.value[s] for s in word_stems(text) if s in wanted.value]
                yield pa.RecordBatch.from_arrays([pa.array([doc], pa.int64()), pa.array([found], pa.list_(pa.int32())),
                                                  pa.array([signature(text)], pa.list_(pa.int64()))], names=["id", "stems", "signature"])

    held = texts.where("toxic").select("id", "text").mapInArrow(post, "id long, stems array<int>, signature array<long>").toPandas()
    listed: dict[str, tuple[list[int], int]] = {s: ([], int(good[s])) for s in good}
    names = list(stems.stem)
    for i, found in enumerate(held.stems):
        for stem in found:
            listed[names[stem]][0].append(i)
    lexicon = Lexicon(choose_stems({s: x for s, x in listed.items() if x[0]}, copy_weights([tuple(s) for s in held.signature]), clean))
    counted = _counts(texts, "id", "text", lexicon, extra=["toxic"]).toPandas()  # the sample's rows
    weights = fit_weights(np.array(counted["kinds"].tolist(), float).reshape(len(counted), len(KINDS)), counted.toxic.to_numpy(float))
    known.unpersist()
    wanted.unpersist()
    discard(texts)
    return Model(lexicon, float(weights[0]), weights[1:])


def _tallied(seen: tuple[Counter, Counter]) -> pa.RecordBatch:
    stems = sorted({*seen[0], *seen[1]})
    out = pa.RecordBatch.from_arrays([pa.array(stems, pa.string()), pa.array([seen[1][s] for s in stems], pa.int64()),
                                      pa.array([seen[0][s] for s in stems], pa.int64())], names=["stem", "bad", "good"])
    seen[0].clear()
    seen[1].clear()
    return out


def _counts(docs: DataFrame, id_col: str, text_col: str, lexicon: Lexicon, extra: list[str] = ()) -> DataFrame:
    """id, extra columns, kinds (matches of each kind)."""
    kept = [F.col(c) for c in (id_col, *extra)]
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in (id_col, *extra)) + ", kinds array<long>"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        built, none = lexicon.build(), [0] * len(KINDS)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            kinds = [count_kinds(text, built) or none if text else none for text in (x.as_py() for x in texts)]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(1 + len(extra))), pa.array(kinds, pa.list_(pa.int64()))],
                                             names=[id_col, *extra, "kinds"])

    return docs.select(*kept, F.col(text_col).alias("_text")).mapInArrow(count, schema)


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, held_out, score, predicted, kinds (matches of each of ``KINDS``); one narrow pass."""
    counted = _counts(docs, id_col, text_col, model.lexicon)
    score = F.lit(float(model.bias))
    for i, w in enumerate(model.weights):
        score = score + F.lit(float(w)) * F.log1p(F.get("kinds", F.lit(i)))
    score = F.lit(1.0) / (F.lit(1.0) + F.exp(-score))
    return counted.select(F.col(id_col), held_out(id_col).alias("held_out"), score.alias("score"), "kinds").withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int"))
