"""Hashes of words and of runs of words, for whole record batches at once in numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Bases of the polynomial hashes: odd, so that they have inverses modulo 2**64.
LETTER = 0x9E3779B97F4A7C15
WORD = 0xD6E8FEB86659FD93

_space = np.zeros(256, bool)
_space[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_lower = np.arange(256, dtype=np.uint64)
_lower[65:91] += 32
_as_is = np.arange(256, dtype=np.uint64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 20)
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        have = np.multiply.accumulate(steps)
        if size <= 1 << 22:
            _powers[base] = have
    return have[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads bits, so that the order of hashes says nothing of the words."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def word_hashes(texts: pa.Array, lower: bool = False, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Of a string array: the hash of every word in order, and where each text's words begin (one entry more than texts).

    Words are runs of other bytes than ASCII white space; a null has none. With lower, A-Z count as a-z.
    """
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], "<i8")[texts.offset : texts.offset + len(texts) + 1]
    first, last = int(offsets[0]), int(offsets[-1])
    if first == last:
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[first:last]
    edges = offsets - first
    word = ~_space[data]
    start, end = word.copy(), word.copy()
    start[1:] &= ~word[:-1]
    end[:-1] &= ~word[1:]
    cut = edges[(edges > 0) & (edges < len(data))]  # a text's end ends its last word
    start[cut] |= word[cut]
    end[cut - 1] |= word[cut - 1]
    s, e = np.flatnonzero(start), np.flatnonzero(end)
    inverse = pow(LETTER, -1, 1 << 64)
    sums = np.cumsum(((_lower if lower else _as_is)[data] + np.uint64(seed + 1)) * powers(LETTER, len(data)), dtype=np.uint64)
    h = sums[e]
    h[1:] -= sums[s[1:] - 1]
    if s[0] > 0:
        h[0] -= sums[s[0] - 1]
    return mixed(h * powers(inverse, len(data))[s]), np.searchsorted(s, edges).astype(np.int64)


def run_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each position on; len(h) - n + 1 of them."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    if n <= 8:
        out = np.zeros(len(h) - n + 1, np.uint64)
        for j in range(n):
            out = out * np.uint64(WORD) + h[j : len(h) - n + 1 + j]
        return mixed(out)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(h * powers(WORD, len(h)), dtype=np.uint64)])
    return mixed((sums[n:] - sums[:-n]) * powers(pow(WORD, -1, 1 << 64), len(h) - n + 1))


def slid(x: np.ndarray, width: int, of=np.minimum) -> np.ndarray:
    """The least (or with np.maximum the greatest) of each `width` values in a row."""
    n = 1
    while n * 2 <= width and len(x) > n:
        x = of(x[:-n], x[n:])
        n *= 2
    rest = width - n
    return of(x[:-rest], x[rest:]) if 0 < rest < len(x) else x[: max(0, len(x) - rest)]


def row_of(offsets: np.ndarray) -> np.ndarray:
    """For each word the number of its text."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
