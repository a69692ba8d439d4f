"""Trie of conversation beginnings, with count-min screening of prefix digests.

Digests. The prefix of the first d turns has the digest
``sum(x_i * B**i, i = 1..d)`` modulo 2**61 - 1 in two lanes, x_i taken from the
SHA-256 of a turn's role and text. Sums can be continued and shifted, so a long
conversation is hashed in parts: rows are dealt by ranges of (conversation,
turn), each task sums its part, and the parts before it are added afterwards
(two rows a task go to the driver for that).

Screening. Tasks count digests in partition sketches, which are merged; the
estimate is never too low, so an estimate of one proves that a prefix has one
member. Below such a prefix a conversation goes on alone: those nodes are
emitted where they are found. Only prefixes that hang on one estimated twice or
more shuffle, to be grouped exactly by both lanes. The sketch has ``LOAD`` to twice as many
cells as there are prefixes, up to ``MOST_CELLS`` (two rows of that many bits,
256 MB, are broadcast at most); beyond, it proves fewer prefixes single and more shuffle, with the same result.

Subtrees. The smallest member of a node owns it, so each conversation owns one
chain of nodes that hangs on a node of a smaller one. Sums over the subtrees
of whole chains come by pointer doubling (as many rounds as the logarithm of
the tree of chains' height), those within a chain by sums over blocks of depths.
A hot prefix, such as a system prompt of a third of all conversations, is a
pre-aggregated group, and a skewed join that adaptive execution splits.

Cases: rows without a conversation id belong to none and are left out. Null
roles and texts are empty. Rows of one turn are ordered by role, the first 64
characters of the text, then its SHA-256; repeated rows are turns of their own.
An empty table has no nodes. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import modular
from .common import discard, materialize
from .textscan import mix

#: Bases of the two lanes.
_BASES = (0x1B873593_5EEDC0DE % modular.PRIME, 0x0CC9E2D51_2545F49 % modular.PRIME)
LOAD = 4                 # cells per prefix, at least
MOST_CELLS = 1 << 30     # cells of a row of the sketch, at most
_BLOCK = 1 << 20         # cells of a row that one task merges
_HELD = 1 << 20          # digests a task holds before it emits a partition sketch
_DEPTHS = 4096           # depths of a chain that are summed in one group
_U = np.uint64


def _columns(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [batch.column(n).to_numpy(zero_copy_only=False) for n in names]


def _lanes(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [a.astype(_U) for a in _columns(batch, *names)]


def _batch(**columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({k: pa.array(v.astype(np.int64) if v.dtype == _U else v) for k, v in columns.items()})


_TURNS = "c long, pid int, place long, h1 long, h2 long, q1 long, q2 long, n long"


def _sum_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (c, d, n) to places and digests within the range; the first and the last
    conversation of the range also get a row with minus their length and their whole digest."""
    pid = TaskContext.get().partitionId()
    now, length, total = None, 0, [0, 0]  # the conversation at the end of the last batch
    first, runs = None, 0

    def edge() -> tuple:
        return now, length, total[0], total[1]

    for batch in batches:
        if not len(batch):
            continue
        c, n = _columns(batch, "c", "n")
        raw = np.frombuffer(b"".join(x[:16] for x in batch.column("d").to_pylist()), "<u8").reshape(-1, 2)
        starts = np.flatnonzero(np.concatenate([[True], c[1:] != c[:-1]]))
        run = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(c))))
        goes_on = now is not None and now == c[0]
        if now is not None and not goes_on:
            first = first or edge()
            runs += 1
        before = length if goes_on else 0
        place = np.arange(len(c)) - starts[run] + 1
        place[run == 0] += before
        if len(starts) > 1 and first is None:
            head_end = starts[1]
        else:
            head_end = None
        out = {}
        for lane in (0, 1):
            # places of the first run go on from the last batch, those of others start at 1
            power = modular.powers(_BASES[lane], len(c), 1)[np.arange(len(c)) - starts[run]]
            if before:
                power[run == 0] = modular.multiply(power[run == 0], pow(_BASES[lane], before, modular.PRIME))
            term = modular.multiply(modular.reduce(raw[:, lane].astype(_U)), power)
            sums = modular.running_sums(term)
            own = modular.subtract(sums[1:], sums[starts[run]])
            if goes_on:
                own[run == 0] = modular.add(own[run == 0], total[lane])
            out[f"h{lane + 1}"], out[f"q{lane + 1}"] = own, modular.subtract(own, term)
        if head_end is not None:
            at = head_end - 1
            first = int(c[at]), int(place[at]), int(out["h1"][at]), int(out["h2"][at])
        runs += len(starts) - 1
        now, length, total = int(c[-1]), int(place[-1]), [int(out["h1"][-1]), int(out["h2"][-1])]
        yield _batch(c=c, pid=np.full(len(c), pid, np.int32), place=place, h1=out["h1"], h2=out["h2"], q1=out["q1"], q2=out["q2"], n=n)
    if now is not None:
        ends = [first, edge()] if runs else [edge()]
        conv, sizes, one, two = (np.array([e[k] for e in ends], np.int64) for k in range(4))
        none = np.zeros(len(ends), np.int64)
        yield _batch(c=conv, pid=np.full(len(ends), pid, np.int32), place=-sizes, h1=one, h2=two, q1=none, q2=none, n=none)


def _carries(edges: list) -> dict[int, tuple[int, int, int, int]]:
    """pid -> (conversation, its rows, its digests) of earlier ranges, where a range begins within a conversation."""
    by_pid: dict[int, list] = {}
    for r in sorted(edges, key=lambda r: (r.pid, r.c)):
        by_pid.setdefault(r.pid, []).append((r.c, -r.place, r.h1, r.h2))
    carries, carry = {}, None
    for pid, ends in by_pid.items():
        if carry and ends[0][0] == carry[0]:
            carries[pid] = carry
            c, size, *lanes = ends[0]
            ends[0] = (c, carry[1] + size, *((carry[2 + k] + lanes[k] * pow(_BASES[k], carry[1], modular.PRIME)) % modular.PRIME for k in (0, 1)))
        carry = ends[-1]
    return carries


def turn_digests(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """c, place (from 1), h1, h2 (digest of the turns up to it), q1, q2 (of those before it), n (code points), for every turn."""
    rows = conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("c"), F.col(turn_col).alias("t"), F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    slim = rows.select("c", "t", "role", F.substring("text", 1, 64).alias("head"),
                       F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)).alias("d"),
                       F.length("text").cast("long").alias("n"))
    ordered = slim.repartitionByRange("c", "t", "role", "head").sortWithinPartitions("c", "t", "role", "head", "d")
    parts = materialize(ordered.select("c", "d", "n").mapInArrow(_sum_parts, _TURNS), "trie-turns")
    carries = _carries(parts.where("place < 0").collect())  # two rows a range at most

    def go_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c, pid, place, n = _columns(batch, "c", "pid", "place", "n")
            lanes = dict(zip(("h1", "h2", "q1", "q2"), _lanes(batch, "h1", "h2", "q1", "q2")))
            place = place.copy()
            for p in np.unique(pid).tolist():
                if p not in carries:
                    continue
                conv, size, *before = carries[p]
                mine = (pid == p) & (c == conv)
                place[mine] += size
                for k in (0, 1):
                    shift = pow(_BASES[k], size, modular.PRIME)
                    for name in (f"h{k + 1}", f"q{k + 1}"):
                        lanes[name][mine] = modular.add(modular.multiply(lanes[name][mine], shift), before[k])
            yield _batch(c=c, place=place, **lanes, n=n)

    return parts.where("place > 0").mapInArrow(go_on, "c long, place long, h1 long, h2 long, q1 long, q2 long, n long")


def shared_heads(turns: DataFrame, group: int = 100, longest: int = 5) -> tuple[DataFrame, DataFrame]:
    """(conversations: c, size; prefixes: c, depth, h1, h2, q1, q2, n, left) after heads are shared.

    Conversation c takes the first h turns of conversation ``c - c % group``
    (all if fewer, none if absent), then its own without its first h;
    h = crc32(decimal c) % (longest + 1). ``longest`` 0 leaves conversations as they are.
    ``left``: turns after the prefix.
    """
    c = F.col("c")
    firsts = [F.max(F.when(F.col("place") == k, F.col(x))).alias(f"{x}_{k}") for k in range(1, longest + 1) for x in ("h1", "h2", "n")]
    own = materialize(turns.groupBy("c").agg(F.max("place").alias("own"), *firsts), "trie-heads")
    base = own.select(*(F.col(x).alias(f"b_{x}") for x in own.columns))
    h = (F.crc32(c.cast("string")) % (longest + 1)).alias("h")

    def pick(prefix: str, k: Column) -> Column:
        out = F.lit(0).cast("long")
        for depth in range(1, longest + 1):
            out = F.when(k == depth, F.col(prefix.format(depth))).otherwise(out)
        return out

    joined = own.withColumn("h", h).withColumn("base", c - c % group).join(base, F.col("base") == F.col("b_c"), "left")
    joined = joined.withColumn("hb", F.least("h", F.coalesce("b_own", F.lit(0))))
    convs = materialize(joined.select(
        "c", F.col("h").cast("long").alias("h"), F.col("hb").cast("long").alias("hb"),
        (F.col("hb") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).cast("long").alias("size"),
        *(F.coalesce(pick(f"b_{x}_{{}}", F.col("hb")), F.lit(0)).alias(f"b{x}") for x in ("h1", "h2")),
        *(F.coalesce(pick(f"{x}_{{}}", F.col("h")), F.lit(0)).alias(f"o{x}") for x in ("h1", "h2")),
        *(F.col(f"b_{x}_{k}") for k in range(1, longest + 1) for x in ("h1", "h2", "n"))), "trie-conversations")
    parts = []
    for k in range(1, longest + 1):
        previous = ["0L", "0L"] if k == 1 else [f"b_h1_{k - 1}", f"b_h2_{k - 1}"]
        parts.append(f"named_struct('depth', {k}L, 'h1', b_h1_{k}, 'h2', b_h2_{k}, 'q1', {previous[0]}, 'q2', {previous[1]}, 'n', b_n_{k})")
    heads = convs.select("c", "size", F.inline(F.slice(F.expr(f"array({', '.join(parts)})"), F.lit(1), F.col("hb").cast("int")))) if parts else None
    tails = turns.join(convs.select("c", "h", "hb", "size", "bh1", "bh2", "oh1", "oh2"), "c").where("place > h")

    def moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            conv, place, hh, hb, size, n = _columns(batch, "c", "place", "h", "hb", "size", "n")
            out = {}
            for k in (1, 2):
                back = np.array([pow(_BASES[k - 1], -s, modular.PRIME) for s in range(longest + 1)], _U)[hh - hb]
                head, cut, *own_lanes = _lanes(batch, f"bh{k}", f"oh{k}", f"h{k}", f"q{k}")
                for name, lane in zip((f"h{k}", f"q{k}"), own_lanes):
                    out[name] = modular.add(modular.multiply(modular.subtract(lane, cut), back), head)
            depth = place - (hh - hb)
            yield _batch(c=conv, depth=depth, h1=out["h1"], h2=out["h2"], q1=out["q1"], q2=out["q2"], n=n, left=size - depth)

    after = tails.mapInArrow(moved, "c long, depth long, h1 long, h2 long, q1 long, q2 long, n long, left long")
    if heads is not None:
        after = heads.select("c", "depth", "h1", "h2", "q1", "q2", "n", (F.col("size") - F.col("depth")).alias("left")).unionByName(after)
    return convs.select("c", "size"), materialize(after, "trie-prefixes")


def _cells(one: np.ndarray, two: np.ndarray, row: int, cells: int) -> np.ndarray:
    return (mix(one ^ mix(two, 3), 21 + row) & _U(cells - 1)).astype(np.int64)


def twice_bits(prefixes: DataFrame, cells: int) -> list[np.ndarray]:
    """Count-min: bits of the cells that hold two digests or more, a row each; cells is a power of two."""
    block = min(_BLOCK, cells)
    blocks = cells // block

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []

        def emit() -> pa.RecordBatch:
            one, two = (np.concatenate([h[k] for h in held]) if held else np.zeros(0, _U) for k in (0, 1))
            held.clear()
            part, once, twice = [], [], []
            for row in (0, 1):
                cell, times = np.unique(_cells(one, two, row, cells), return_counts=True)
                edges = np.searchsorted(cell, np.arange(blocks + 1) * block)
                for b in np.flatnonzero(np.diff(edges)).tolist():
                    own, often = cell[edges[b]: edges[b + 1]] - b * block, times[edges[b]: edges[b + 1]] > 1
                    part.append(row * blocks + b)
                    once.append(own[~often].astype("<u4").tobytes())
                    twice.append(own[often].astype("<u4").tobytes())
            return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(once, pa.binary()), pa.array(twice, pa.binary())],
                                              names=["part", "once", "twice"])

        for batch in batches:
            held.append(_lanes(batch, "h1", "h2"))
            if sum(len(h[0]) for h in held) >= _HELD:
                yield emit()
        yield emit()

    def merge(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        times = np.zeros(block, np.uint8)
        for batch in batches:
            for once, twice in zip(batch.column("once"), batch.column("twice")):
                seen = np.frombuffer(once.as_py(), "<u4")
                times[seen] = np.minimum(times[seen] + 1, 2)
                times[np.frombuffer(twice.as_py(), "<u4")] = 2
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()),
                                          pa.array([np.packbits(times == 2, bitorder="little").tobytes()], pa.binary())], names=["part", "bits"])

    merged = prefixes.select("h1", "h2").mapInArrow(count, "part int, once binary, twice binary").groupBy("part").applyInArrow(merge, "part int, bits binary")
    bits = [np.zeros(max(1, cells // 8), np.uint8) for _ in (0, 1)]
    for r in merged.toLocalIterator():  # as many rows as the sketch has blocks
        own = np.frombuffer(r.bits, np.uint8)
        at = r.part % blocks * (block // 8)
        bits[r.part // blocks][at: at + len(own)] = own
    return bits


def _mark(prefixes: DataFrame, cells: int) -> DataFrame:
    """Adds ``shared``: the prefix hangs on the root or on one that the sketch counts twice."""
    bits = prefixes.sparkSession.sparkContext.broadcast(twice_bits(prefixes, cells))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = _lanes(batch, "q1", "q2")
            twice = np.ones(len(batch), bool)
            for row in (0, 1):
                cell = _cells(one, two, row, cells)
                twice &= (bits.value[row][cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 == 1
            yield batch.append_column("shared", pa.array(twice | (_columns(batch, "depth")[0] == 1)))

    return prefixes.mapInArrow(mark, "c long, depth long, h1 long, h2 long, q1 long, q2 long, n long, left long, shared boolean")


def _end_hashes(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ids that end at each node, in order; a stream a node, so of any length."""
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: dict[str, list] = {"depth": [], "h1": [], "h2": [], "ends": []}
        now = running = None
        for batch in batches:
            for key in zip(*(x.to_pylist() for x in batch.columns)):
                if key[:3] != now:
                    if now is not None:
                        out["ends"].append(running.hexdigest())
                    now, running = key[:3], hashlib.sha256(b"%d" % key[3])
                    for name, value in zip(out, now):
                        out[name].append(value)
                else:
                    running.update(b",%d" % key[3])
        if now is not None:
            out["ends"].append(running.hexdigest())
        yield pa.RecordBatch.from_pydict({k: pa.array(v, pa.string() if k == "ends" else pa.int64()) for k, v in out.items()})

    keys = ["depth", "h1", "h2"]
    return ends.select(*keys, "c").repartition(*keys).sortWithinPartitions(*keys, "c").mapInArrow(digest, "depth long, h1 long, h2 long, ends string")


def _chain_sums(chains: DataFrame) -> DataFrame:
    """chains (c, host, at, up, leaf, saved), up null where nothing is to be passed on: leaf and saved become sums
    over all chains that hang on a chain, directly or not. Each round passes on twice as far."""
    now = materialize(chains, "trie-chains")
    while now.where("up IS NOT NULL").limit(1).count():
        passed = now.where("up IS NOT NULL").groupBy(F.col("up").alias("to")).agg(F.sum("leaf").alias("more_leaf"), F.sum("saved").alias("more_saved"))
        summed = now.join(passed, F.col("c") == F.col("to"), "left").select(
            "c", "host", "at", "up", (F.col("leaf") + F.coalesce("more_leaf", F.lit(0))).alias("leaf"),
            (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"))
        jumps = now.where("up IS NOT NULL").select(F.col("c").alias("via"), F.col("up").alias("next"))
        further = materialize(summed.join(jumps, F.col("up") == F.col("via"), "left").select(
            "c", "host", "at", F.col("next").alias("up"), "leaf", "saved"), "trie-chains")
        discard(now)
        now = further
    return now


def _suffix_sums(nodes: DataFrame) -> DataFrame:
    """sum_leaf and sum_saved over the nodes of the same chain from ``depth`` on; a long chain is summed in blocks."""
    nodes = nodes.withColumn("block", F.floor(F.col("depth") / _DEPTHS))
    blocks = nodes.groupBy("c", "block").agg(F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved"))
    later = Window.partitionBy("c").orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("c", "block", *(F.coalesce(F.sum(x).over(later), F.lit(0)).alias(f"later_{x}") for x in ("leaf", "saved")))
    inside = Window.partitionBy("c", "block").orderBy(F.col("depth").desc()).rowsBetween(Window.unboundedPreceding, 0)
    return nodes.select("*", *(F.sum(x).over(inside).alias(f"in_{x}") for x in ("leaf", "saved"))).join(blocks, ["c", "block"]).withColumns(
        {f"sum_{x}": F.col(f"in_{x}") + F.col(f"later_{x}") for x in ("leaf", "saved")})


def prefix_trie(convs: DataFrame, prefixes: DataFrame, load: int = LOAD, most_cells: int = MOST_CELLS) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``convs``: c, size; ``prefixes``: as ``shared_heads`` gives them, each (c, depth) once."""
    nobody = F.sha2(F.lit(""), 256)
    count = prefixes.count()
    cells = max(8, min(most_cells, 1 << max(0, load * count - 1).bit_length()))
    marked = _mark(prefixes, cells)
    alone = marked.where("NOT shared").select(
        F.col("c").alias("conv_id"), "depth", F.col("c").alias("parent_conv_id"), F.lit(1).cast("long").alias("n_convs"),
        (F.col("left") > 0).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"),
        F.when(F.col("left") == 0, F.sha2(F.col("c").cast("string"), 256)).otherwise(nobody).alias("ends_sha256"))
    shared = materialize(marked.where("shared"), "trie-shared")
    first = convs.agg(F.min("c"), F.count(F.lit(1))).first()
    least, total = first[0], first[1]
    if least is None:  # no conversation, no root
        return alone
    key = ["depth", "h1", "h2"]
    nodes = materialize(shared.groupBy(*key).agg(F.min("c").alias("c"), F.count(F.lit(1)).alias("m"), F.max("n").alias("n"), F.max("q1").alias("q1"),
                                                 F.max("q2").alias("q2"), F.max("left").alias("left")), "trie-nodes")
    below = nodes.where("depth > 1").groupBy((F.col("depth") - 1).alias("depth"), F.col("q1").alias("h1"), F.col("q2").alias("h2")).agg(
        F.count(F.lit(1)).alias("children"))
    ends = _end_hashes(shared.where("left = 0"))
    owners = nodes.where("m > 1").select((F.col("depth") + 1).alias("depth"), F.col("h1").alias("q1"), F.col("h2").alias("q2"), F.col("c").alias("owner"))
    linked = nodes.join(owners, ["depth", "q1", "q2"], "left").join(below, key, "left").join(ends, key, "left")
    linked = materialize(linked.select(
        "c", "depth", "m", "n", F.when(F.col("depth") == 1, F.lit(least)).otherwise(F.coalesce("owner", "c")).alias("parent"),
        F.when(F.col("m") == 1, (F.col("left") > 0).cast("long")).otherwise(F.coalesce("children", F.lit(0))).alias("children"),
        F.coalesce("ends", nobody).alias("ends")), "trie-linked")
    tops = linked.where("depth = 1").count()
    root_end = _end_hashes(convs.where("size = 0").select("c", *(F.lit(0).cast("long").alias(k) for k in key))).first()
    root = linked.sparkSession.createDataFrame(
        [(least, 0, total, 0, None, tops, root_end.ends if root_end else hashlib.sha256(b"").hexdigest())],
        "c long, depth long, m long, n long, parent long, children long, ends string")
    everything = linked.unionByName(root)
    # one chain for each owner: where it hangs, whether its last node has no child, what its own nodes save
    foreign = F.col("parent") != F.col("c")
    chains = everything.groupBy("c").agg(
        F.max(F.when(foreign, F.col("parent"))).alias("host"), F.max(F.when(foreign, F.col("depth") - 1)).alias("at"),
        F.max(F.when((F.col("depth") > 0) & (F.col("m") == 1) | (F.col("children") == 0), 1).otherwise(0)).cast("long").alias("leaf"),
        F.sum((F.col("m") - 1) * F.col("n")).alias("saved"))
    bare = materialize(chains, "trie-bare")
    sums = _chain_sums(bare.withColumn("up", F.when(F.col("host") != least, F.col("host"))).select("c", "host", "at", "up", "leaf", "saved"))
    hanging = sums.where("host IS NOT NULL").groupBy(F.col("host").alias("c"), F.col("at").alias("depth")).agg(
        F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved"))
    several = everything.where("m > 1 OR depth = 0").join(hanging, ["c", "depth"], "left").select(
        "c", "depth", "m", "parent", "children", "ends", F.coalesce("leaf", F.lit(0)).alias("leaf"),
        ((F.col("m") - 1) * F.col("n") + F.coalesce("saved", F.lit(0))).alias("saved"))
    several = _suffix_sums(several).join(bare.select("c", F.col("leaf").alias("own_leaf")), "c")
    single = everything.where("m = 1 AND depth > 0")
    named = [F.col("c").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("m").alias("n_convs"), F.col("children").alias("n_children")]
    return several.select(*named, (F.col("sum_leaf") + F.col("own_leaf")).alias("n_leaves"), F.col("sum_saved").alias("saved_tokens"),
                          F.col("ends").alias("ends_sha256")).unionByName(
        single.select(*named, F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"), F.col("ends").alias("ends_sha256"))
    ).unionByName(alone)
