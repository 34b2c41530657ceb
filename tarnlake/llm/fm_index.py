"""A compressed full-text index over words: Burrows-Wheeler transform in a wavelet matrix of packed bits."""

from __future__ import annotations

import numpy as np


class Bits:
    """A packed bit vector with rank: 64-bit words and one running count for each of them."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros(-(-(len(bits) + 1) // 64) * 64, np.uint8)
        padded[:len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        ones = np.bitwise_count(self.words).astype(np.int32)
        self.before = np.cumsum(ones, dtype=np.int32) - ones

    def rank(self, at: np.ndarray) -> np.ndarray:
        """How many bits are set before each position."""
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        below = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.before[word] + np.bitwise_count(below)


class WaveletMatrix:
    """Ranks of symbols in a sequence, one bit of the symbol a level."""

    def __init__(self, symbols: np.ndarray, n_symbols: int):
        self.shifts = range(max(1, int(n_symbols - 1).bit_length()) - 1, -1, -1)
        self.levels, self.zeros = [], []
        for shift in self.shifts:
            bit = (symbols >> shift & 1).astype(bool)
            self.levels.append(Bits(bit))
            self.zeros.append(int(len(symbols) - bit.sum()))
            symbols = np.concatenate([symbols[~bit], symbols[bit]])
        every = np.arange(n_symbols)
        self.origin = self._follow(every, np.zeros(n_symbols, np.int64))

    def _follow(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        for shift, level, zeros in zip(self.shifts, self.levels, self.zeros):
            ones = level.rank(at)
            at = np.where(symbols >> shift & 1, zeros + ones, at - ones)
        return at

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each position."""
        return self._follow(symbols, at) - self.origin[symbols]


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions in the order of their suffixes, compared by at least ``depth`` symbols."""
    n, rank, width = len(text), text.astype(np.int64), 1
    while width < depth:
        ahead = np.full(n, -1, np.int64)
        ahead[:max(0, n - width)] = rank[width:]
        keys = rank * (int(rank.max()) + 2) + ahead + 1
        order = np.argsort(keys, kind="stable")
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(np.diff(keys[order]) != 0)])
        width *= 2
    return np.argsort(rank, kind="stable")


class FmIndex:
    """An index over texts of symbols 1, 2, ...; 0 ends each text. Patterns may have up to ``depth`` symbols."""

    def __init__(self, text: np.ndarray, n_symbols: int, depth: int):
        self.order = suffix_order(text, depth)
        self.below = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=n_symbols))])
        self.matrix = WaveletMatrix(text[self.order - 1], n_symbols)

    def matching_statistics(
        self, text: np.ndarray, ends: np.ndarray, depth: int, least: int = 2,
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Backward search from each end position of a streamed text, until ``depth`` symbols are matched or
        fewer than ``least`` places are left: the symbols matched, and the suffix interval of those that
        reached ``depth`` (else an empty one)."""
        matched = np.zeros(len(ends), np.int64)
        low_of, high_of = np.zeros(len(ends), np.int64), np.zeros(len(ends), np.int64)
        live = np.arange(len(ends))
        low, high = np.zeros(len(ends), np.int64), np.full(len(ends), len(self.order))
        for back in range(depth):
            symbol = text[ends[live] - back]
            low = self.below[symbol] + (self.matrix.rank(symbol, low) if back else 0)
            high = self.below[symbol] + self.matrix.rank(symbol, high) if back else self.below[symbol + 1]
            keep = high - low >= least
            live, low, high = live[keep], low[keep], high[keep]
            matched[live] = back + 1
            if not len(live):
                break
        done = matched[live] == depth
        low_of[live[done]], high_of[live[done]] = low[done], high[done]
        return matched, low_of, high_of

    def least_in(self, values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The least of ``values`` (by text position) among the places of each interval. Intervals of equal
        depth are equal or apart."""
        starts, which = np.unique(low, return_inverse=True)
        stops = np.zeros(len(starts), np.int64)
        stops[which] = high
        edges = np.column_stack([starts, stops]).ravel()
        by_order = np.append(values[self.order], np.iinfo(np.int64).max)
        return np.minimum.reduceat(by_order, edges)[::2][which] if len(edges) else np.zeros(0, np.int64)
