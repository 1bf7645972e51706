"""An FM-index over sequences of integer symbols: a wavelet tree over their Burrows-Wheeler transform, in numpy."""

from __future__ import annotations

import numpy as np

_ONE = np.uint64(1)


def _ranks(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Dense ranks of the pairs (high, low)."""
    pairs = high.astype(np.int64) * (int(low.max(initial=0)) + 1) + low
    return np.unique(pairs, return_inverse=True)[1].reshape(-1).astype(np.int64)


def _shifted(ranks: np.ndarray, by: int) -> np.ndarray:
    """Rank `by` places further; beyond the end ranks below all others."""
    out = np.zeros(len(ranks), np.int64)
    out[: max(len(ranks) - by, 0)] = ranks[by:] + 1
    return out


def order_by_prefix(symbols: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order of their first `depth` symbols, and the dense rank of every suffix by them."""
    ranks, done = np.unique(symbols, return_inverse=True)[1].reshape(-1).astype(np.int64), 1
    while done < depth:
        step = min(done, depth - done)
        ranks, done = _ranks(ranks, _shifted(ranks, step)), done + step
    return np.argsort(ranks, kind="stable"), ranks


class _Bits:
    """Bit vector with constant-time counts: packed words and the count before each word."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        self.before = np.r_[0, np.cumsum(np.bitwise_count(self.words), dtype=np.int64)].astype(np.int32)
        self.zeros = int(len(bits) - bits.sum(dtype=np.int64))

    def ones(self, at: np.ndarray) -> np.ndarray:
        """Set bits before each place."""
        word = at >> 6
        below = (_ONE << (at & 63).astype(np.uint64)) - _ONE
        return self.before[word] + np.bitwise_count(self.words[word] & below)


class FMIndex:
    """Counts occurrences of patterns of up to `depth` symbols; symbols are 0 to `top`, 0 only separates sequences."""

    def __init__(self, symbols: np.ndarray, top: int, depth: int):
        self.depth = depth
        self.suffixes, self.ranks = order_by_prefix(symbols, depth)
        last = symbols[self.suffixes - 1]  # the symbol before each suffix; before the first comes the last
        self.first = np.r_[0, np.cumsum(np.bincount(symbols, minlength=top + 1))].astype(np.int64)
        self.levels = []
        for bit in range(max(1, int(top).bit_length()) - 1, -1, -1):
            ones = ((last >> bit) & 1).astype(np.uint8)
            self.levels.append((bit, _Bits(ones)))
            last = np.r_[last[ones == 0], last[ones == 1]]

    def _before(self, symbol: np.ndarray, at: np.ndarray, start: bool = False) -> np.ndarray:
        """Place in the last level that `at` comes to when following `symbol` down the tree."""
        for bit, bits in self.levels:
            ones = bits.ones(at)
            at = np.where((symbol >> bit) & 1, bits.zeros + ones, at - ones)
        return at

    def step(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search: intervals of the patterns with `symbol` put in front."""
        n = len(symbol)
        ends = self._before(np.r_[symbol, symbol, symbol], np.r_[np.zeros(n, np.int64), lo, hi])
        return self.first[symbol] + ends[n : 2 * n] - ends[:n], self.first[symbol] + ends[2 * n :] - ends[:n]

    def matching(self, symbols: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Matching statistics of streamed symbols: for the patterns that end at `ends` (inclusive) and are extended
        to the left, up to `depth` symbols, while they occur more than once: (length, lo, hi)."""
        lo, hi = self.first[symbols[ends]], self.first[symbols[ends] + 1]
        length = np.ones(len(ends), np.int64)
        live = np.flatnonzero(hi - lo > 1)
        for back in range(1, self.depth):
            if not len(live):
                break
            lo[live], hi[live] = self.step(symbols[ends[live] - back], lo[live], hi[live])
            live = live[hi[live] - lo[live] > 1]
            length[live] = back + 1
        return length, lo, hi
