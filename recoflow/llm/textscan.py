"""Words and hashes of whole batches of texts with numpy.

Works on the UTF-8 bytes of an Arrow string array, all rows at once.
Words are ``[^\\x20\\x09-\\x0D]+``; these separators are single bytes that
never occur inside another character, so bytes and characters agree.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Odd multipliers of the two polynomial hashes over the (mixed) hashes of words.
_WORD_BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
_U = np.uint64


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x + _U((seed * 0x632BE59BD9B4E019 + 0x9E3779B97F4A7C15) & (2**64 - 1))
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


@lru_cache(maxsize=8)
def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    def row(b: int) -> np.ndarray:
        out = np.full(size, b, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)
    return row(base), row(pow(base, -1, 2**64))


def _run_sums(values: np.ndarray, base: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hash of values[start:end] for every pair, modulo 2**64."""
    size = 1 << max(16, int(len(values) + 1).bit_length())
    up, down = _powers(base, size)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=total[1:])
    return (total[ends] - total[starts]) * down[starts]


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, family: int) -> np.ndarray:
    """A 64-bit hash of the bytes of every run (none empty).

    Blocks of eight bytes are mixed, each with its place, before they are
    summed: no polynomial in the bytes, for which equal sums can be built.
    Runs of one size of at most eight bytes never collide.
    """
    if not len(starts):
        return np.zeros(0, np.uint64)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    size = ends - starts
    count = (size + 7) >> 3
    first = np.concatenate([[0], np.cumsum(count)[:-1]])
    place = np.arange(int(count.sum())) - np.repeat(first, count)
    at = np.repeat(starts, count) + 8 * place
    left = np.minimum(np.repeat(ends, count) - at, 8).astype(np.uint64)
    block = eights[at] & (~_U(0) >> (_U(64) - left * _U(8)))
    tags = mix(np.arange(int(count.max()), dtype=np.uint64), 31 + family)
    sums = np.add.reduceat(mix(block ^ tags[place], family), first)
    return mix(sums + size.astype(np.uint64) * _U(0x9E3779B97F4A7C15), family)


class Words:
    """Words of one slice: ``start``, ``end`` (bytes) and ``doc`` (row) of each."""

    def __init__(self, texts: pa.Array, lower: bool = False):
        n = len(texts)
        buffers = texts.buffers()
        offsets = np.frombuffer(buffers[1], np.int64)[texts.offset: texts.offset + n + 1]
        raw = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
        self.data = raw[offsets[0]: offsets[-1]] if n else raw[:0]
        self.bounds = (offsets - offsets[0]) if n else np.zeros(1, np.int64)
        self.n_docs = n
        if lower:
            self.data = np.where((self.data >= 65) & (self.data <= 90), self.data + 32, self.data).astype(np.uint8)
        size = len(self.data)
        word = ~_SPACE[self.data]
        before = np.zeros(size, bool)
        after = np.zeros(size, bool)
        before[1:] = word[:-1]
        after[:-1] = word[1:]
        before[self.bounds[:-1][self.bounds[:-1] < size]] = False
        inner = self.bounds[1:]
        after[inner[inner > 0] - 1] = False
        self.start = np.flatnonzero(word & ~before)
        self.end = np.flatnonzero(word & ~after) + 1
        self.doc = np.searchsorted(self.bounds, self.start, side="right") - 1
        #: words of row i are first[i]:first[i+1]
        self.first = np.searchsorted(self.doc, np.arange(n + 1))
        self.count = np.diff(self.first)

    def hashes(self, family: int = 0) -> np.ndarray:
        """A 64-bit hash of every word; families are independent."""
        return run_hashes(self.data, self.start, self.end, family)

    def window_starts(self, k: int) -> np.ndarray:
        """First word of every window of k words inside one row."""
        at = np.arange(max(0, len(self.doc) - k + 1))
        return at[self.doc[at] == self.doc[at + k - 1]] if len(at) else at

    def windows(self, hashes: np.ndarray, k: int, family: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """(start word, hash) of every window of k words inside one row."""
        at = self.window_starts(k)
        return at, mix(_run_sums(hashes, _WORD_BASES[family], at, at + k), family + 2)

    def covered(self, starts: np.ndarray, k: int) -> np.ndarray:
        """Mask of the words that lie in a window beginning at one of ``starts``."""
        size = len(self.start) + 1
        step = np.bincount(starts, minlength=size) - np.bincount(starts + k, minlength=size)
        return np.cumsum(step[:-1]) > 0


def byte_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of every run."""
    return run_hashes(data, starts, ends, 1)


def segment_sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sum of values[start:end] for every pair (float64 or int64)."""
    total = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])
    return total[ends] - total[starts]
