"""Hashes of the words and shingles of a text, computed on whole arrays."""

from __future__ import annotations

import numpy as np

_U = np.uint64
_STEP = 0x9E3779B97F4A7C15  # odd, so powers have inverses modulo 2^64
_INVERSE = pow(_STEP, -1, 1 << 64)
_SPACES = np.zeros(256, dtype=bool)
_SPACES[[0x20, *range(0x09, 0x0E)]] = True
_powers = np.ones(1, dtype=_U)
_inverses = np.ones(1, dtype=_U)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _byte_values() -> np.ndarray:
    values = mix(np.arange(1, 257, dtype=_U) * _U(_STEP))
    values[65:91] = values[97:123]  # A-Z count as a-z
    return values


_VALUES = _byte_values()


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the step and of its inverse, up to ``n``."""
    global _powers, _inverses
    if len(_powers) < n:
        size = max(n, 2 * len(_powers), 1 << 14)
        made = []
        for base in (_STEP, _INVERSE):
            p = np.full(size, base, dtype=_U)
            p[0] = 1
            made.append(np.multiply.accumulate(p))
        _powers, _inverses = made
    return _powers[:n], _inverses[:n]


def word_hashes(text: str | None) -> np.ndarray:
    """A 64-bit hash of every word ``[^\\x20\\x09-\\x0D]+`` in order, A-Z as a-z."""
    data = np.frombuffer((text or "").encode("utf-8"), dtype=np.uint8)
    if not len(data):
        return np.zeros(0, dtype=_U)
    inside = np.concatenate(([False], ~_SPACES[data], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[0::2], edges[1::2]
    powers, inverses = _tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=_U)
    np.cumsum(_VALUES[data] * powers[:-1], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverses[starts] + (ends - starts).astype(_U))


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct hashes of all shingles of ``words`` words; of the whole sequence if it is shorter."""
    w = word_hashes(text)
    n = len(w)
    if n == 0:
        return w
    size = min(words, n)
    factors = mix(np.arange(1, size + 1, dtype=_U) * _U(0xD1342543DE82EF95)) | _U(1)
    total = np.full(n - size + 1, size, dtype=_U)
    for i in range(size):
        total = mix(total + w[i:n - size + 1 + i] * factors[i])
    return np.unique(total)
