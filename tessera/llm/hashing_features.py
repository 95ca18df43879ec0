"""Vectorised hashing of the words and byte n-grams of many texts at once."""

from __future__ import annotations

import numpy as np

MIX = np.uint64(0x9E3779B97F4A7C15)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: byte class: letters (also of multi-byte characters), capitals, digits, every other byte by itself
_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[97:123] = 1
_CLASS[128:] = 1
_CLASS[65:91] = 2
_CLASS[48:58] = 3
_POW = np.cumprod(np.full(64, 0x100000001B3, np.uint64))


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * MIX
    return h ^ (h >> np.uint64(29))


_TABLE = mix(np.arange(1, 257, dtype=np.uint64) * MIX)


def _runs(first: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Order-dependent hash of each run of ``values``; ``first`` marks where runs begin."""
    at = np.flatnonzero(first)
    pos = np.arange(len(values)) - np.repeat(at, np.diff(np.append(at, len(values))))
    return mix(np.add.reduceat(_TABLE[values] * _POW[pos & 63], at))


def words(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of each word, hash of the lower-cased word, hash of its shape)."""
    row, h, shape, _ = words_at(raw, off)
    return row, h, shape


def words_at(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """As ``words``, and where each word begins."""
    body = ~_SPACE[raw]
    start = body.copy()
    start[1:] &= ~body[:-1]
    rows = off[:-1][np.diff(off) > 0]
    start[rows] = body[rows]
    at = np.flatnonzero(start)
    if not len(at):
        z = np.zeros(0, np.uint64)
        return np.zeros(0, np.int64), z, z, at
    row = np.searchsorted(off, at, side="right") - 1
    b, first = raw[body], start[body]
    h = _runs(first, _LOWER[b])
    c = _CLASS[b]
    turn = first.copy()
    turn[1:] |= c[1:] != c[:-1]
    return row, h, _runs(first[turn], c[turn]), at


def ngram_counts(raw: np.ndarray, off: np.ndarray, buckets: int, orders=(2, 3, 4)) -> np.ndarray:
    """Hashed counts (rows x buckets) of lower-cased byte n-grams within rows;
    every ASCII byte that is no letter counts as a blank."""
    n = len(off) - 1
    b = _LOWER[raw]
    b = np.where((b >= 97) & (b <= 122) | (b >= 128), b, 32).astype(np.uint64)
    row = np.repeat(np.arange(n), np.diff(off))
    out = np.zeros(n * buckets, np.float32)
    h = b.copy()
    for k in range(2, max(orders) + 1):
        if len(b) < k:
            break
        h = (h[:-1] * np.uint64(257)) + b[k - 1:]
        if k in orders:
            inside = row[:len(h)] == row[k - 1:]
            x = mix(h + np.uint64(k * int(MIX) & 0xFFFFFFFFFFFFFFFF)) & np.uint64(buckets - 1)
            flat = row[:len(h)] * buckets + x.astype(np.int64)
            out += np.bincount(flat[inside], minlength=n * buckets)
    return out.reshape(n, buckets)
