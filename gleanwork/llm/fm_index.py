"""FM-index over integer symbols: suffix order, wavelet matrix ranks, sampled positions."""

from __future__ import annotations

import numpy as np

SAMPLE_EVERY = 8


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of all suffixes. Each 0 counts as a symbol of its own, below all others, so that
    comparisons end at it."""
    breaks = text == 0
    rank = np.where(breaks, np.cumsum(breaks), text.astype(np.int64) + int(breaks.sum()))
    step, n = 1, len(text)
    while True:
        after = np.zeros(n, dtype=np.int64)
        after[:-step or None] = rank[step:] if step < n else 0
        key = rank * (int(rank.max(initial=0)) + 1) + after
        order = np.argsort(key, kind="stable")
        fresh = np.ones(n, dtype=np.int64)
        fresh[1:] = key[order[1:]] != key[order[:-1]]
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.cumsum(fresh)
        if fresh.all() or step >= n:
            return order
        step *= 2


class WaveletMatrix:
    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits, self.ones, self.zeros = bits, [], []
        for level in range(bits - 1, -1, -1):
            bit = (symbols >> level) & 1
            ones = np.zeros(len(symbols) + 1, dtype=np.int32)
            np.cumsum(bit, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(len(symbols) - int(ones[-1]))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def rank(self, symbol: np.ndarray, upto: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each position."""
        low, high = np.zeros_like(upto), upto
        for k, (ones, zeros) in enumerate(zip(self.ones, self.zeros, strict=True)):
            one = ((symbol >> (self.bits - 1 - k)) & 1).astype(bool)
            a, b = ones[low], ones[high]
            low = np.where(one, zeros + a, low - a)
            high = np.where(one, zeros + b, high - b)
        return high - low


class FMIndex:
    """Index of a text of symbols 1..sigma in which every run ends with a 0."""

    def __init__(self, text: np.ndarray, sigma: int):
        order = suffix_array(text)
        self.n = len(text)
        before = np.where(order > 0, text[order - 1], 0)
        self.bwt = before
        self.ranks = WaveletMatrix(before, max(1, int(sigma).bit_length()))
        counts = np.bincount(text, minlength=sigma + 1)
        self.first = np.concatenate([[0], np.cumsum(counts)])[:-1]
        # Run starts are sampled too, so that no walk leaves its run.
        sampled = (order % SAMPLE_EVERY == 0) | (before == 0)
        self.sampled = sampled
        self.nth = np.cumsum(sampled) - 1
        self.positions = order[sampled]

    def back(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        return self.first[symbol] + self.ranks.rank(symbol, row)

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pattern, from row, to row) of the patterns that occur; all of one length, one per line."""
        who = np.arange(len(patterns))
        low = np.zeros(len(patterns), dtype=np.int64)
        high = np.full(len(patterns), self.n, dtype=np.int64)
        for k in range(patterns.shape[1] - 1, -1, -1):
            symbol = patterns[who, k]
            low, high = self.back(symbol, low), self.back(symbol, high)
            alive = low < high
            who, low, high = who[alive], low[alive], high[alive]
            if not len(who):
                break
        return who, low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text position of each row: step back to the next sampled one."""
        rows, steps = rows.copy(), np.zeros(len(rows), dtype=np.int64)
        todo = np.flatnonzero(~self.sampled[rows])
        while len(todo):
            rows[todo] = self.back(self.bwt[rows[todo]], rows[todo])
            steps[todo] += 1
            todo = todo[~self.sampled[rows[todo]]]
        return self.positions[self.nth[rows]] + steps
