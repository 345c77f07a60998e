"""FM-index over sequences of small integers, in numpy.

The text is runs of symbols 1, 2, ... between separators (0). Every separator is smaller than all symbols and
different from all other separators, so suffixes are told apart at the end of their run at the latest.

Built: the suffix order (prefix doubling, in which only suffixes that are still
tied are sorted again), the Burrows-Wheeler transform as a wavelet matrix, the counts of smaller symbols, and the
positions of every ``step``-th suffix and of all run starts.
"""

from __future__ import annotations

import numpy as np


def suffix_ranks(symbols: np.ndarray) -> np.ndarray:
    """Place of each suffix in the order of all suffixes. The last symbol must be a separator."""
    n = len(symbols)
    separator = symbols == 0
    rank = np.empty(n, np.int64)
    rank[separator] = np.arange(int(separator.sum()))
    counts = np.bincount(symbols)
    below = np.cumsum(counts) - counts
    rank[~separator] = below[symbols[~separator]]
    tied = np.flatnonzero(~separator & (counts[symbols] > 1))
    width = 1
    while len(tied):
        base = rank[tied]
        # a tied suffix has no separator in its first ``width`` symbols, so the other half exists
        following = rank[tied + width]
        order = np.argsort(base * n + following, kind="stable")
        tied, base, following = tied[order], base[order], following[order]
        at = np.arange(len(tied))
        new_base = np.concatenate([[True], base[1:] != base[:-1]])
        new = new_base | np.concatenate([[True], following[1:] != following[:-1]])
        first_of_base = np.maximum.accumulate(np.where(new_base, at, 0))
        first = np.maximum.accumulate(np.where(new, at, 0))
        rank[tied] = base + first - first_of_base
        size = np.diff(np.append(np.flatnonzero(new), len(tied)))
        tied = tied[np.repeat(size > 1, size)]
        width *= 2
    return rank


class WaveletMatrix:
    """rank(symbol, i): how often a symbol stands before place i."""

    def __init__(self, values: np.ndarray, top: int):
        self.levels: list[tuple[int, np.ndarray, int]] = []
        self.starts: dict[int, int] = {}
        for bit in reversed(range(max(1, int(top).bit_length()))):
            ones = (values >> bit) & 1
            before = np.zeros(len(values) + 1, np.int32)
            np.cumsum(ones, out=before[1:])
            zeros = len(values) - int(before[-1])
            self.levels.append((bit, before, zeros))
            mask = ones.astype(bool)
            values = np.concatenate([values[~mask], values[mask]])

    def rank(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        start = np.zeros(len(symbols), np.int64)
        end = places.astype(np.int64)
        for bit, before, zeros in self.levels:
            one = ((symbols >> bit) & 1).astype(bool)
            a, b = before[start].astype(np.int64), before[end].astype(np.int64)
            start = np.where(one, zeros + a, start - a)
            end = np.where(one, zeros + b, end - b)
        return end - start


class FmIndex:
    def __init__(self, symbols: np.ndarray, top: int, step: int = 16):
        """symbols end with a separator and do not exceed ``top``."""
        n = len(symbols)
        rank = suffix_ranks(symbols)
        self.bwt = np.empty(n, symbols.dtype)
        self.bwt[rank] = np.roll(symbols, 1)
        self.matrix = WaveletMatrix(self.bwt, top)
        counts = np.bincount(symbols, minlength=top + 1)
        self.below = np.cumsum(counts) - counts
        self.size = n
        at = np.arange(n)
        kept = (at % step == 0) | (np.roll(symbols, 1) == 0)
        # the known positions, in suffix order
        self.known = np.zeros(n, bool)
        self.known[rank[kept]] = True
        self.known_before = np.concatenate([[0], np.cumsum(self.known)])
        self.positions = np.empty(int(kept.sum()), np.int64)
        self.positions[self.known_before[rank[kept]]] = at[kept]

    def ranges(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search of all phrases at once. phrases: one row each, filled from the right."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), self.size, np.int64)
        live = np.arange(len(phrases))
        for k in range(phrases.shape[1]):
            live = live[(lengths[live] > k) & (low[live] < high[live])]
            if not len(live):
                break
            c = phrases[live, phrases.shape[1] - 1 - k]
            low[live] = self.below[c] + self.matrix.rank(c, low[live])
            high[live] = self.below[c] + self.matrix.rank(c, high[live])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text position of each row of the suffix order: step back until a known position."""
        rows = rows.copy()
        back = np.zeros(len(rows), np.int64)
        live = np.flatnonzero(~self.known[rows])
        while len(live):
            c = self.bwt[rows[live]]
            rows[live] = self.below[c] + self.matrix.rank(c, rows[live])
            back[live] += 1
            live = live[~self.known[rows[live]]]
        return self.positions[self.known_before[rows]] + back
