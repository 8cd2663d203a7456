"""A compressed full-text index of a shard: suffix order, wavelet matrix, backward search.

Symbols are dense numbers.  Suffixes are sorted by at least ``depth + 1`` symbols (prefix
doubling), which is as far as searches for ``depth`` symbols and one more look.  The last
column (the symbol before each suffix) is kept as a wavelet matrix: per bit of a symbol a bit
vector with counts at every 64th place, from which ranks follow.
"""

from __future__ import annotations

import numpy as np

_ONE = np.uint64(1)


class WaveletMatrix:
    """Ranks of symbols in prefixes of a sequence."""

    def __init__(self, symbols: np.ndarray, size: int):
        self.bits = max(1, int(size - 1).bit_length())
        self.words, self.counts, self.zeros = [], [], []
        now = symbols
        for bit in range(self.bits - 1, -1, -1):
            ones = (now >> bit & 1).astype(bool)
            packed = np.packbits(np.concatenate([ones, np.zeros(64 + -len(ones) % 64, bool)]),
                                 bitorder="little").view(np.uint64)
            self.words.append(packed)
            self.counts.append(np.concatenate([[0], np.cumsum(np.bitwise_count(packed))])
                               .astype(np.int64))
            self.zeros.append(len(ones) - int(ones.sum()))
            now = np.concatenate([now[~ones], now[ones]])
        self.starts = self._descend(np.arange(size), np.zeros(size, np.int64))

    def _descend(self, symbols: np.ndarray, place: np.ndarray) -> np.ndarray:
        for k, bit in enumerate(range(self.bits - 1, -1, -1)):
            word = place >> 6
            below = (_ONE << (place & 63).astype(np.uint64)) - _ONE
            ones = self.counts[k][word] + np.bitwise_count(self.words[k][word] & below)
            place = np.where(symbols >> bit & 1, self.zeros[k] + ones, place - ones)
        return place

    def rank(self, symbols: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place."""
        return self._descend(symbols, place) - self.starts[symbols]


class FMIndex:
    """Backward search for runs of ``depth`` symbols."""

    def __init__(self, symbols: np.ndarray, size: int, depth: int):
        n = len(symbols)
        ranks, width, rank = {1: symbols}, 1, symbols.astype(np.int64)
        while width <= depth:
            behind = np.zeros(n, np.int64)
            behind[:max(0, n - width)] = rank[width:] + 1
            _, rank = np.unique(rank * (n + size + 1) + behind, return_inverse=True)
            width *= 2
            ranks[width] = rank
        self.suffixes = np.argsort(rank, kind="stable")
        self.last = WaveletMatrix(symbols[self.suffixes - 1], size)
        self.firsts = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=size))])
        # Rows whose suffixes agree in ``depth`` symbols form a block.
        same, at = np.ones(max(0, n - 1), bool), 0
        for width in sorted(ranks, reverse=True):
            if depth - at >= width:
                here = np.minimum(self.suffixes + at, n - 1)
                inside = self.suffixes + at < n
                value = np.where(inside, ranks[width][here], -1)
                same &= value[1:] == value[:-1]
                at += width
        self.block = np.concatenate([[0], np.cumsum(~same)])[:n]
        self.block_starts = np.flatnonzero(np.concatenate([[True], ~same]))[:n]
        self.block_ends = np.append(self.block_starts[1:], n)

    def extend(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray) \
            -> tuple[np.ndarray, np.ndarray]:
        """The row intervals after one more symbol on the left."""
        both = self.last.rank(np.concatenate([symbols, symbols]), np.concatenate([low, high]))
        first = self.firsts[symbols]
        return first + both[:len(symbols)], first + both[len(symbols):]

    def shorten(self, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of the first ``depth`` symbols of rows ``low``."""
        block = self.block[low]
        return self.block_starts[block], self.block_ends[block]


def stream(index: FMIndex, symbols: np.ndarray, starts: np.ndarray, sizes: np.ndarray,
           depth: int):
    """Stream runs of symbols through the index from their right ends, all runs in step.

    Yields (runs, places, lows) for the places from which ``depth`` symbols match, with the
    first row of the interval of matches.  Runs that stop matching leave the stream, so every
    run must be a part of the indexed symbols to be followed to its start.
    """
    run = np.arange(len(starts))
    low, high = np.zeros(len(run), np.int64), np.full(len(run), len(symbols))
    for t in range(int(sizes.max(initial=0))):
        on = (t < sizes[run]) & (low < high)
        run, low, high = run[on], low[on], high[on]
        if not len(run):
            return
        place = starts[run] + sizes[run] - 1 - t
        low, high = index.extend(symbols[place], low, high)
        if t >= depth:
            low, high = index.shorten(low)
        if t >= depth - 1:
            hit = low < high
            yield run[hit], place[hit], low[hit]
