"""Conversation operators against plain statements of their rules."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from recoflow.llm import conversation_repair, modular, prefix_trie, queries

FULL = re.compile("[^\x20\x09-\x0D]")
EXTRA = ", c long, t long, d string, copy int, _code long, `present` string"


def chats() -> list[tuple]:
    """(conv_id, turn, role, text): nulls, other roles, ties, copies, one long conversation, shared beginnings."""
    rng = random.Random(3)
    say = lambda: " ".join("".join(rng.choice("abcé") for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(1, 6))) + rng.choice([".", ".", "?", "", " ! \n"])
    rows: list[tuple] = []
    for conv in [*range(0, 60), *range(100, 130), 205, 399, -3, None]:
        if rng.random() < 0.3:
            rows.append((conv, 0, "system", rng.choice(["Be kind.", say()])))
        for turn in range(1, rng.randint(1, 9)):
            role = rng.choice(["user", "assistant"]) if rng.random() < 0.3 else ("user" if turn % 2 else "assistant")
            rows.append((conv, turn * rng.choice([1, 1, 1, 2]), role, say()))
    rows += [(300, None, "user", "a."), (300, None, None, "b"), (300, 4, "tool", None), (300, 4, "", " "), (300, 4, "user", "a."), (300, -2, "user", "x y")]
    rows += [(301, 5, "user", "same."), (301, 5, "user", "same."), (302, None, None, None), (303, 1, "ü", "é日本😀."), (304, 2, "assistant", "z" * 50_000)]
    rows += [(400, k, "user" if k % 2 else "assistant", rng.choice(["ja.", "no.", say(), say()])) for k in range(400)]
    rows += [(c, k, "user" if k % 2 else "assistant", f"line {k}.") for c in (500, 501, 600) for k in range(12)]
    return rows


@pytest.fixture(scope="module")
def talk():
    return chats()


@pytest.fixture(scope="module")
def talks(spark, talk):
    return spark.createDataFrame([(*r, 1, 2, "x", 3, 4, "p") for r in talk], "conv_id long, turn long, role string, text string" + EXTRA).repartition(5)


def _order(row):
    role, text = row[1], row[2]
    digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
    return (row[0] is not None, row[0] or 0, role, text[:64], digest)


def cheapest(signs: list[tuple[str, bool, bool]]) -> tuple[int, str]:
    """Least (cost, audit) by plain relaxation; signs: (initial, must be deleted, truncated)."""
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
    best = {0: (0, ""), 3: (0, "")}
    for i in range(len(signs), -1, -1):
        if i < len(signs):
            initial, gone, cut = signs[i]
            new: dict = {}
            for state in range(4):
                ways = [(best[state][0] + 4, "D" + best[state][1])] if state in best else []
                for role in "sua":
                    after = step.get((state, role))
                    if after in best and not gone:
                        if role == initial:
                            ways.append((best[after][0] + 3 * cut, "K" + best[after][1]))
                        if role != "s":
                            ways.append((best[after][0] + 3 + 3 * cut, "R" + best[after][1]))
                if ways:
                    new[state] = min(ways)
            best = new
        for _ in range(6):  # insertions before row i
            for state in range(4):
                for role in "ua":
                    after = step.get((state, role))
                    if after in best:
                        way = best[after][0] + 3, "I" + best[after][1]
                        best[state] = min(best.get(state, way), way)
    return best[0]


def repaired(talk) -> set[tuple]:
    groups = collections.defaultdict(list)
    for conv, turn, role, text in talk:
        role, text = " " if role is None else role, " " if text is None else text
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        rows = groups[conv]
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        rows += [(turn, "user" if code == 4 else role, text)] * {0: 0, 3: 2}.get(code, 1)
    out = set()
    for conv, rows in groups.items():
        rows.sort(key=_order)
        seen, signs, count = set(), [], collections.Counter()
        for _, role, text in rows:
            full = FULL.findall(text)
            fault = "blank" if not full else "duplicate" if (role, text) in seen else "truncated" if full[-1] not in ".!?" else ""
            seen.add((role, text))
            count[fault] += 1
            signs.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(signs, signs[1:]))
        cost, audit = cheapest(signs)
        turns = {t for t, _, _ in rows if t is not None}
        lines, left, last = [], iter(rows), ""
        for edit in audit:
            turn, role, text = next(left) if edit != "I" else (None, "", "")
            if edit == "D":
                continue
            role = role if edit == "K" else "assistant" if last == "u" else "user"
            last = role[0]
            lines.append(f"{role}:{text}")
        out.add((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, count["blank"], count["duplicate"], count["truncated"], illegal,
                 cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return out


COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def _op12(monkeypatch, table):
    monkeypatch.setattr(queries, "_table", lambda spark, sf_dir, name: table)
    return {tuple(r[c] for c in COLUMNS) for r in queries.op12_conversation_repair(table.sparkSession, "").collect()}


@pytest.mark.parametrize("segment", [3, 64])
def test_repair(talks, talk, monkeypatch, segment):
    # the task function is shipped with its module, so the smaller segments are set on the rows' side
    monkeypatch.setattr(conversation_repair, "_segments", _with_segment(segment))
    found, want = _op12(monkeypatch, talks), repaired(talk)
    assert found == want
    assert any(r[6] > 20 for r in want) and any(r[8] == hashlib.sha256(b"").hexdigest() for r in want)


def _with_segment(rows):
    whole = conversation_repair._segments

    def segments(batches):
        conversation_repair.SEGMENT = rows
        return whole(batches)
    return segments


def test_repair_over_many_ranges(spark, talks, talk, monkeypatch):
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert _op12(monkeypatch, talks) == repaired(talk)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_repair_of_nothing(talks, monkeypatch):
    assert _op12(monkeypatch, talks.where("false")) == set()


def test_derivations_of_all_short_segments_are_cheapest():
    rng = random.Random(1)
    for _ in range(3000):
        signs = "".join(rng.choice("dsuaxSUAX") for _ in range(rng.randint(0, 9)))
        rows = [(s.lower(), s == "d", s.isupper()) for s in signs]
        cut = rng.randint(0, len(signs))
        for parts in ([signs], [signs[:cut], signs[cut:]], list(signs)):
            items = {0: conversation_repair.Derivation(0, "", None)}
            for part in parts:
                items = conversation_repair.join_items(items, [tuple(x) for x in conversation_repair.derive(part)])
            best = min(items[q] for q in (0, 3) if q in items)
            assert (best.cost, best.audit()) == cheapest(rows)


def test_repaired_rows_are_legal(talks):
    _, rows = conversation_repair.repair(talks)
    shapes = rows.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", F.substring("role", 1, 1).alias("r")))),
                                                                  lambda x: x["r"]), "").alias("shape"))
    assert shapes.where(~F.col("shape").rlike("^s?(ua)+$")).count() == 0


def trie(talk, group=100, longest=5) -> set[tuple]:
    """The nodes by plain recursion over rebuilt conversations."""
    own = collections.defaultdict(list)
    for conv, turn, role, text in talk:
        if conv is not None:
            own[conv].append((turn, role or "", text or ""))
    for rows in own.values():
        rows.sort(key=_order)
    whole = {}
    for c, rows in own.items():
        h = zlib.crc32(str(c).encode()) % (longest + 1)
        base = c - (abs(c) % group) * (1 if c >= 0 else -1)
        whole[c] = [r[1:] for r in own.get(base, [])[:h]] + [r[1:] for r in rows[h:]]
    members = collections.defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children, leaves, saved = collections.Counter(), collections.Counter(), collections.Counter()
    for path in members:
        children[path[:-1]] += len(path) > 0
    for path, ids in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += not children[path]
            saved[path[:d]] += (len(ids) - 1) * len(path[-1][1]) if path else 0
    return {(min(ids), len(path), min(members[path[:-1]]) if path else None, len(ids), children[path], leaves[path], saved[path],
             hashlib.sha256(",".join(str(c) for c in sorted(ids) if len(whole[c]) == len(path)).encode()).hexdigest())
            for path, ids in members.items()}


NODE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


@pytest.mark.parametrize("cells, longest, partitions", [(1 << 20, 5, 4), (8, 5, 19), (64, 0, 3)])
def test_trie(spark, talks, talk, cells, longest, partitions):
    """Also with sketches far too small, which prove almost nothing single, and over many ranges."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        convs, prefixes = prefix_trie.shared_heads(prefix_trie.turn_digests(talks), longest=longest)
        found = [tuple(r[c] for c in NODE) for r in prefix_trie.prefix_trie(convs, prefixes, most_cells=cells).collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    want = trie(talk, longest=longest)
    assert len(found) == len(want) and set(found) == want
    assert any(r[3] > 1 and r[1] > 5 for r in want)


def test_trie_of_nothing(talks):
    for table in (talks.where("false"), talks.where("conv_id IS NULL")):
        convs, prefixes = prefix_trie.shared_heads(prefix_trie.turn_digests(table))
        assert prefix_trie.prefix_trie(convs, prefixes).count() == 0


def test_arithmetic_modulo_the_prime():
    rng = random.Random(2)
    p = modular.PRIME
    a = [0, 1, p - 1, p - 2, *(rng.randrange(p) for _ in range(500))]
    b = [p - 1, p - 1, p - 1, 2, *(rng.randrange(p) for _ in range(500))]
    x, y = np.array(a, np.uint64), np.array(b, np.uint64)
    assert modular.multiply(x, y).tolist() == [i * j % p for i, j in zip(a, b)]
    assert modular.subtract(x, y).tolist() == [(i - j) % p for i, j in zip(a, b)]
    assert modular.running_sums(x).tolist() == [sum(a[:k]) % p for k in range(len(a) + 1)]
    assert modular.powers(12345, 70, 3).tolist() == [pow(12345, 3 + k, p) for k in range(70)]
