"""Hashes of words and of runs of words for a whole batch of texts at once, in numpy.

Words are maximal runs of bytes that are not white space (0x20 and 0x09 to 0x0D). A word's hash is
a polynomial over random values of its bytes, taken from running sums; all arithmetic wraps
around modulo 2**64.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_VALUES = np.random.default_rng(7).integers(1, 1 << 64, 256, np.uint64, endpoint=False)
_LOWER = _VALUES.copy()
_LOWER[65:91] = _VALUES[97:123]
_IS_WORD = np.ones(256, bool)
_IS_WORD[[9, 10, 11, 12, 13, 32]] = False
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> list[np.ndarray]:
    if len(_powers[0]) <= n:
        size = max(n + 1, 1 << 20)
        for k, base in enumerate((_BASE, _INVERSE)):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers[k] = np.multiply.accumulate(table)
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and where the words of each text begin (one more entry at the end)."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if len(texts) == 0 or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    word = np.zeros(len(data) + 2, bool)
    word[1:-1] = _IS_WORD[data]
    begins, stops = word[1:-1] & ~word[:-2], word[1:-1] & ~word[2:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]   # a text's end ends its last word
    begins[inner] = word[1:-1][inner]
    stops[inner - 1] = word[1:-1][inner - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    power, inverse = _power_tables(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((_LOWER if lower else _VALUES)[data] * power[:len(data)], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
    return hashes, np.searchsorted(starts, offsets)


def run_hashes(words: np.ndarray, bounds: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, position) of each run of ``length`` words that lies within one text."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = words[:n].copy()
    for k in range(1, length):
        total = total * np.uint64(_BASE) + words[k:n + k]
    inside = np.ones(n, bool)
    for k in range(1, length):
        crossed = bounds[1:-1] - k     # a run from here reaches into the next text
        inside[crossed[(crossed >= 0) & (crossed < n)]] = False
    at = np.flatnonzero(inside)
    return mix(total[at]), at
