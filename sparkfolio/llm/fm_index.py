"""Compressed FM-index over word sequences, with backward search on a wavelet matrix.

The text is a concatenation of word sequences, each closed by a separator that
sorts before every word. The Burrows-Wheeler transform is kept only as one bit
vector per bit of the (dense) word code, with a rank sample for each 64 bits. Search
states are intervals of suffixes; a backward step is two ranks on each level, done
for many sequences at once.
"""

from __future__ import annotations

import numpy as np

_ONE = np.uint64(1)
_WORD = np.uint64(64)


class Bits:
    """Bit vector with constant-time rank."""

    def __init__(self, bits: np.ndarray):
        raw = np.packbits(bits, bitorder="little")
        words = np.zeros(len(bits) // 64 + 1, np.uint64)
        words.view(np.uint8)[:len(raw)] = raw
        self.words = words
        self.before = np.zeros(len(words), np.uint32)
        np.cumsum(np.bitwise_count(words)[:-1], out=self.before[1:], dtype=np.uint32)
        self.ones = int(bits.sum())

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        word = at >> 6
        low = (_ONE << (at & 63).astype(np.uint64)) - _ONE
        return self.before[word].astype(np.int64) + np.bitwise_count(self.words[word] & low)


def suffix_order(codes: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, group) by prefix doubling until every suffix differs or ``depth`` words are
    compared; ``group`` marks the first suffix of each set that shares its first ``depth`` words.
    The comparison width is trimmed so that it ends at exactly ``depth`` words."""
    n = len(codes)
    rank = codes.astype(np.int64)
    have, order = 1, np.argsort(rank, kind="stable")
    while have < depth:
        step = min(have, depth - have)
        nxt = np.zeros(n, np.int64)
        nxt[:n - step] = rank[step:] + 1
        both = rank * (int(rank.max()) + 2) + nxt
        order = np.argsort(both, kind="stable")
        new = np.concatenate(([0], np.cumsum(both[order][1:] != both[order][:-1])))
        rank = np.empty(n, np.int64)
        rank[order] = new
        have += step
    first = np.concatenate(([True], rank[order][1:] != rank[order][:-1]))
    return order, first


class FMIndex:
    """Index over ``codes`` (0: separator, words from 1), ordered to ``depth`` words.

    Suffixes that share ``depth`` words are not ordered further; a search is cut to ``depth`` words,
    and its interval then holds the whole set that shares them."""

    def __init__(self, codes: np.ndarray, depth: int):
        self.depth = depth
        order, first = suffix_order(codes, depth)
        bwt = codes[order - 1]                               # the text is read as a circle
        self.n = len(codes)
        self.start = np.concatenate(([0], np.cumsum(np.bincount(codes))))
        self.levels: list[Bits] = []
        width = max(1, int(codes.max()).bit_length())
        rest = bwt.astype(np.int64)
        for level in range(width - 1, -1, -1):
            bit = (rest >> level) & 1 == 1
            self.levels.append(Bits(bit))
            rest = np.concatenate((rest[~bit], rest[bit]))
        edge = np.flatnonzero(first)
        self.group = Bits(first)
        self.edges = np.append(edge, self.n)
        self._matrix_start = self._starts(width)

    def _starts(self, width: int) -> np.ndarray:
        """Where the run of each symbol begins on the last level of the matrix."""
        symbols = np.arange(len(self.start) - 1)
        at = np.zeros(len(symbols), np.int64)
        for level, bits in zip(range(width - 1, -1, -1), self.levels, strict=True):
            one = (symbols >> level) & 1 == 1
            ones = bits.rank(at)
            at = np.where(one, self.n - bits.ones + ones, at - ones)
        return at

    def occurrences(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often ``symbol`` stands before ``at`` in the transform."""
        top = len(self.levels) - 1
        for i, bits in enumerate(self.levels):
            one = (symbol >> (top - i)) & 1 == 1
            ones = bits.rank(at)
            at = np.where(one, self.n - bits.ones + ones, at - ones)
        return at - self._matrix_start[symbol]

    def extend(self, low: np.ndarray, high: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward step: the suffixes that begin with ``symbol`` and go on as those in [low, high)."""
        base = self.start[symbol]
        return base + self.occurrences(symbol, low), base + self.occurrences(symbol, high)

    def widen(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of all suffixes that share the first ``depth`` words of those in [low, high)."""
        number = self.group.rank(low + 1)
        return self.edges[number - 1], self.edges[number]

    def repeated(self, codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Matching statistics at the threshold: for every word position, whether the ``depth`` words
        from there occur at two places of the index or more.

        ``starts`` and ``lengths`` give the sequences streamed against the index, which have to be among
        the indexed ones. All are read backwards together, one word a step; a match that is ``depth``
        words long drops its last word as it takes a new one."""
        out = np.zeros(len(codes), bool)
        order = np.argsort(-lengths, kind="stable")
        starts, lengths = starts[order], lengths[order]
        low, high = np.zeros(len(starts), np.int64), np.full(len(starts), self.n, np.int64)
        for done in range(int(lengths.max(initial=0))):
            live = int(np.searchsorted(-lengths, -done, side="left"))
            low, high = low[:live], high[:live]
            at = starts[:live] + lengths[:live] - 1 - done
            low, high = self.extend(low, high, codes[at])
            if done + 1 >= self.depth:
                low, high = self.widen(low, high)
                out[at] = high - low >= 2
        return out
