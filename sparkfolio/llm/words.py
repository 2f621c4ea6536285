"""Words and word hashes of whole texts, vectorised over Arrow string batches.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D
(``[^\\x20\\x09-\\x0D]+``). These separators are ASCII, so the rule can be
applied to UTF-8 bytes. Tasks call :func:`slices` to walk a batch in pieces of
bounded size; one piece always holds whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once by one task (a longer text is handled alone).
SLICE_BYTES = 1 << 20
#: Most texts in one piece.
SLICE_TEXTS = 4096

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BYTE2 = np.random.default_rng(20250117).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 2**64)
_POW: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser, so that all bits of a hash are usable."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    have = _POW.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, SLICE_BYTES + 1), base, np.uint64)
        have[0] = 1
        np.cumprod(have, out=have)
        if len(have) <= 2 * SLICE_BYTES:
            _POW[base] = have
    return have[:n]


def range_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of ``values[s:e]`` for every range: equal sequences, equal hashes."""
    n = len(values)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(values * _powers(_BASE, n), out=total[1:])
    raw = (total[ends] - total[starts]) * _powers(_BASE_INV, n + 1)[starts]
    return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


@dataclass
class Words:
    """Words of some texts: ``starts``/``ends`` are byte offsets into ``data``;
    text ``i`` owns words ``first[i]:first[i + 1]`` and bytes ``bounds[i]:bounds[i + 1]``."""

    data: np.ndarray
    bounds: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def n(self) -> np.ndarray:
        return np.diff(self.first)

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.n)

    def hashes(self, again: bool = False) -> np.ndarray:
        """64-bit hash of every word; ``again`` gives another one, of other values of the bytes."""
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        return range_hash((_BYTE2 if again else _BYTE)[self.data], self.starts, self.ends)

    def grams(self, hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(positions, hashes) of the ``k``-word windows that lie inside one text."""
        if len(hashes) < k:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        last = np.repeat(self.first[1:], self.n)
        at = np.flatnonzero(np.arange(len(hashes)) + k <= last)
        return at, range_hash(hashes, at, at + k)


def split(data: np.ndarray, bounds: np.ndarray) -> Words:
    inside = ~_SPACE[data]
    n = len(data)
    edge = np.zeros(n + 1, bool)
    edge[bounds] = True
    start = np.flatnonzero(inside & (edge[:n] | np.concatenate(([True], ~inside[:-1])))) if n else np.zeros(0, np.int64)
    end = np.flatnonzero(inside & (edge[1:] | np.concatenate((~inside[1:], [True])))) + 1 if n else np.zeros(0, np.int64)
    return Words(data, bounds, start, end, np.searchsorted(start, bounds))


def slices(texts: pa.Array, lower: bool = False, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, Words]]:
    """Yield ``(from_row, to_row, Words)`` over pieces of about ``limit`` bytes; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1 + texts.offset)[texts.offset:]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        to = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        to = min(max(to, at + 1), at + SLICE_TEXTS, len(texts))
        piece = data[offsets[at]:offsets[to]]
        yield at, to, split(_LOWER[piece] if lower else piece, offsets[at:to + 1] - offsets[at])
        at = to
