"""Arithmetic modulo the prime 2**61 - 1 on whole arrays, for hashes of sequences."""

from __future__ import annotations

import numpy as np

PRIME = (1 << 61) - 1
_P = np.uint64(PRIME)
_U = np.uint64


def reduce(x: np.ndarray) -> np.ndarray:
    """x modulo the prime, for any 64-bit x."""
    x = (x & _P) + (x >> _U(61))
    return np.where(x >= _P, x - _P, x)


def multiply(a: np.ndarray, b: np.ndarray | int) -> np.ndarray:
    """a * b; both below the prime."""
    a, b = np.asarray(a, _U), np.asarray(b, _U)
    low = _U((1 << 31) - 1)
    a1, a0, b1, b0 = a >> _U(31), a & low, b >> _U(31), b & low
    middle = a1 * b0 + a0 * b1
    # 2**61 counts as 1, so 2**62 as 2
    return reduce(a1 * b1 * _U(2) + (middle >> _U(30)) + ((middle & _U((1 << 30) - 1)) << _U(31)) + a0 * b0)


def add(a: np.ndarray, b: np.ndarray | int) -> np.ndarray:
    return reduce(np.asarray(a, _U) + np.asarray(b, _U))


def subtract(a: np.ndarray, b: np.ndarray | int) -> np.ndarray:
    return reduce(np.asarray(a, _U) + (_P - np.asarray(b, _U)))


def powers(base: int, count: int, first: int = 0) -> np.ndarray:
    """base ** first, base ** (first + 1), ... (``count`` values)."""
    out = np.empty(max(1, count), _U)
    out[0] = pow(base, first, PRIME)
    done = 1
    while done < count:
        more = min(done, count - done)
        out[done: done + more] = multiply(out[:more], pow(base, done, PRIME))
        done += more
    return out[:count]


def running_sums(x: np.ndarray) -> np.ndarray:
    """Sums of all beginnings of x, each modulo the prime; one longer than x, from 0."""
    low = np.zeros(len(x) + 1, _U)
    high = np.zeros(len(x) + 1, _U)
    np.cumsum(x & _U((1 << 31) - 1), out=low[1:])
    np.cumsum(x >> _U(31), out=high[1:])
    return add(multiply(reduce(high), 1 << 31), reduce(low))
