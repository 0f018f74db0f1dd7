"""Vectorised hashing of the words of one text.  Pure functions on numpy arrays, used inside tasks."""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)
_powers = np.ones(1, dtype=np.uint64)
_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

WHITE = np.zeros(256, dtype=bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
# White space, control bytes and ASCII punctuation: what is left is letters, digits and bytes of other scripts.
NOT_WORD = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        grown = np.full(max(n, 2 * len(_powers)), _BASE, dtype=np.uint64)
        grown[0] = 1
        _powers = np.cumprod(grown, dtype=np.uint64)
    return _powers


def word_hashes(data: bytes, separators: np.ndarray = WHITE) -> np.ndarray:
    """A 64-bit hash for each maximal run of bytes that are no separators, in order."""
    return placed_words(data, separators)[0]


def placed_words(data: bytes, separators: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray]:
    """`word_hashes`, and the byte at which each word starts."""
    a = np.frombuffer(data, dtype=np.uint8)
    inside = np.zeros(len(a) + 2, dtype=bool)
    np.logical_not(separators[a], out=inside[1:-1])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[0::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, dtype=np.uint64), starts
    lengths = ends - starts
    # Words are summed together with the separators after them, whose value is 0.
    place = np.arange(starts[0], len(a)) - np.repeat(starts, np.diff(starts, append=len(a)))
    longest = int(lengths.max())
    values = _BYTE[a[starts[0] :]] * _power(longest)[np.minimum(place, longest - 1)]
    values *= inside[1 + starts[0] : -1]
    sums = np.add.reduceat(values, starts - starts[0])
    return mix(sums + lengths.astype(np.uint64) * _BASE), starts


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash for each run of `size` (at most 256) neighbouring words."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    for j in range(size):
        total += words[j : j + n] * _PLACE[j]
    return mix(total)


def _sliding(best, x: np.ndarray, window: int) -> np.ndarray:
    """`best` (np.minimum or np.maximum) over every `window` neighbours, by doubling."""
    size = 1
    while 2 * size <= window:
        x = best(x[:-size], x[size:])
        size *= 2
    return best(x[: len(x) - (window - size)], x[window - size :]) if size < window else x


def minimiser_positions(hashes: np.ndarray, window: int) -> np.ndarray:
    """Positions whose hash is the smallest of some `window` neighbouring hashes.

    Chosen by content alone: two texts that share `window` neighbouring hashes share a chosen one.
    A text with fewer hashes gives its smallest.  In a run of equal hashes (a repeated word) only
    every `window`-th position from its start is taken, and the last.
    """
    n = len(hashes)
    if n == 0:
        return np.zeros(0, dtype=np.int64)
    window = min(window, n)
    least = _sliding(np.minimum, hashes, window)
    edge = np.zeros(window - 1, dtype=np.uint64)
    chosen = np.flatnonzero(_sliding(np.maximum, np.concatenate([edge, least, edge]), window) == hashes)
    same = np.flatnonzero(hashes[1:] == hashes[:-1])
    if not len(same):
        return chosen
    start = np.arange(n)
    start[same + 1] = 0
    start = np.maximum.accumulate(start)
    inner = np.zeros(n, dtype=bool)
    inner[same] = True  # the next one is equal
    return chosen[~inner[chosen] | ((chosen - start[chosen]) % window == 0)]
