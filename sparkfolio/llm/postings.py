"""Packed posting rows: many (key, node) pairs in one row, so that a shuffle of
all shingles of a corpus moves about eight bytes a pair.

A key has ``KEY_BITS`` bits. Its top ``bits`` bits name the bucket (a column),
the rest travels as six bytes. The number of buckets follows the input, so a
bucket keeps about ``BUCKET_PAIRS`` pairs at any size.
"""

from __future__ import annotations

import math

import numpy as np

KEY_BITS = 52
#: Pairs that one bucket holds on average.
BUCKET_PAIRS = 1 << 20
MIN_BITS = KEY_BITS - 48


def bucket_bits(pairs: int) -> int:
    return min(24, max(MIN_BITS, math.ceil(math.log2(max(1, pairs / BUCKET_PAIRS)))))


def pack48(x: np.ndarray) -> bytes:
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpack48(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.reshape(-1).view("<u8").astype(np.uint64)


def cut(sorted_keys: np.ndarray, n: int) -> np.ndarray:
    """Borders of the values 0..n-1 in a sorted array."""
    return np.searchsorted(sorted_keys, np.arange(n + 1))


def runs(sorted_values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first index, length) of every run of equal values."""
    if not len(sorted_values):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.flatnonzero(np.concatenate(([True], sorted_values[1:] != sorted_values[:-1])))
    return first, np.diff(np.append(first, len(sorted_values)))
