"""Vectorised 64-bit hashes of words, of runs of words and of runs of bytes, and minimizers."""

from __future__ import annotations

import numpy as np

_M = np.uint64(0x9E3779B97F4A7C15)
_A = np.uint64(0xBF58476D1CE4E5B9)
_B = np.uint64(0x94D049BB133111EB)
_ODD = 0xD6E8FEB86659FD93

#: Low bits of a packed minimum hold the place, the others the hash.
PLACE_BITS = 31


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


_BYTES = mixed(np.arange(1, 257, dtype=np.uint64) * _M)


def _powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), _ODD, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


#: Words are hashed together byte by byte up to this length, what is left of longer ones at once.
_TOGETHER = 64


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash for each byte range; equal bytes, equal hash.

    Memory is a few numbers a word, and a few numbers a byte of words above ``_TOGETHER`` bytes.
    """
    length = end - start
    order = np.argsort(-length, kind="stable")
    first, sizes = start[order], length[order]
    total = np.zeros(len(start), np.uint64)
    power = _powers(int(sizes[0]) if len(sizes) else 0)
    longer = np.searchsorted(-sizes, -np.arange(_TOGETHER), "left")
    for i, n in enumerate(longer.tolist()):
        if not n:
            break
        total[:n] += _BYTES[data[first[:n] + i]] * power[i]
    n = int(np.searchsorted(-sizes, -_TOGETHER, "left"))
    if n:
        rest = sizes[:n] - _TOGETHER
        begin = np.cumsum(rest) - rest
        within = np.arange(int(rest.sum())) - np.repeat(begin, rest) + _TOGETHER
        terms = _BYTES[data[np.repeat(first[:n], rest) + within]] * power[within]
        total[:n] += np.add.reduceat(terms, begin)
    out = np.empty_like(total)
    out[order] = mixed(total + sizes.astype(np.uint64) * _M)
    return out


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every ``k`` consecutive values; one for each place that has so many ahead."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    # Doubling: runs of 1, 2, 4, ... values, joined where the bits of k say so.
    out, done, run, size = None, 0, hashes, 1
    while size <= k:
        if k & size:
            part = run[done : done + n]
            out = part.copy() if out is None else out * np.uint64(pow(_ODD, size, 1 << 64)) + part
            done += size
        if size * 2 <= k:
            run = run[:-size] * np.uint64(pow(_ODD, size, 1 << 64)) + run[size:]
        size *= 2
    return mixed(out + np.uint64(k))


def byte_values(data: np.ndarray) -> np.ndarray:
    """A hash for each byte."""
    return _BYTES[data]


def minimizers(hashes: np.ndarray, w: int) -> np.ndarray:
    """Place of the smallest of each ``w`` consecutive hashes, the first of equal ones.

    It depends on the hashes alone, so equal windows have their minimum at the same distance.
    """
    n = len(hashes) - w + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    place = np.uint64((1 << PLACE_BITS) - 1)
    best = (hashes & ~place) | np.arange(len(hashes), dtype=np.uint64)
    size = 1
    while size * 2 <= w:
        best = np.minimum(best[:-size], best[size:])
        size *= 2
    if size < w:
        best = np.minimum(best[: n], best[w - size : w - size + n])
    return (best[:n] & place).astype(np.int64)
