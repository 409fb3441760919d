"""FM-index over integer symbols, searched for many patterns at once.

Suffix array by prefix doubling, Burrows-Wheeler transform in a wavelet
matrix (one bit vector with ranks per bit of the alphabet), and every
``sample``-th suffix position kept to locate occurrences.  All searches
advance together, so the cost per symbol is an array operation.
"""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Text ends with a unique smallest symbol."""
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    step = 1
    while True:
        following = np.zeros(len(text), dtype=np.int64)
        following[:-step] = rank[step:] + 1
        key = rank * (len(text) + 2) + following
        order = np.argsort(key, kind="stable")
        key = key[order]
        rank = np.empty(len(text), dtype=np.int64)
        rank[order] = np.cumsum(np.concatenate([[0], key[1:] != key[:-1]]))
        step *= 2
        if rank[order[-1]] == len(text) - 1 or step >= len(text):
            return order


class FMIndex:
    """``text``: symbols >= 1; a terminal 0 is added."""

    def __init__(self, text: np.ndarray, sample: int = 8):
        text = np.append(text.astype(np.int64), 0)
        order = suffix_array(text)
        bwt = text[order - 1]
        self.n, self.sigma = len(text), int(text.max()) + 1
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=self.sigma))])
        self.levels, self.zeros = [], []
        self.bits = max(1, int(self.sigma - 1).bit_length())
        for level in range(self.bits - 1, -1, -1):
            bit = (bwt >> level) & 1
            self.levels.append(np.concatenate([[0], np.cumsum(bit)]).astype(np.int32))
            self.zeros.append(self.n - int(self.levels[-1][-1]))
            bwt = np.concatenate([bwt[bit == 0], bwt[bit == 1]])
        kept = order % sample == 0
        self.kept_rank = np.concatenate([[0], np.cumsum(kept)])
        self.kept = order[kept]

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each position of the transform."""
        start, end = np.zeros_like(at), at
        for ones, zeros, level in zip(self.levels, self.zeros, range(self.bits - 1, -1, -1)):
            bit = (symbols >> level) & 1 == 1
            start = np.where(bit, zeros + ones[start], start - ones[start])
            end = np.where(bit, zeros + ones[end], end - ones[end])
        return end - start

    def symbol_and_rank(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        symbols, start, end = np.zeros_like(at), np.zeros_like(at), at
        for ones, zeros in zip(self.levels, self.zeros):
            bit = ones[end + 1] > ones[end]
            symbols = symbols * 2 + bit
            start = np.where(bit, zeros + ones[start], start - ones[start])
            end = np.where(bit, zeros + ones[end], end - ones[end])
        return symbols, end - start

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of right-aligned patterns (a matrix, one row each)."""
        low = np.zeros(len(patterns), dtype=np.int64)
        high = np.full(len(patterns), self.n, dtype=np.int64)
        width = patterns.shape[1]
        for step in range(width):
            live = np.nonzero((lengths > step) & (low < high))[0]
            if not len(live):
                break
            symbols = patterns[live, width - 1 - step]
            known = symbols < self.sigma
            high[live[~known]] = 0
            low[live[~known]] = 0
            live, symbols = live[known], symbols[known]
            low[live] = self.before[symbols] + self.rank(symbols, low[live])
            high[live] = self.before[symbols] + self.rank(symbols, high[live])
        return low, high

    def locate(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(pattern, text position) of every occurrence."""
        counts = np.maximum(high - low, 0)
        which = np.repeat(np.arange(len(low)), counts)
        rows = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(low, counts)
        positions, steps = np.zeros(len(rows), dtype=np.int64), 0
        todo = np.arange(len(rows))
        while len(todo):
            sampled = self.kept_rank[rows[todo] + 1] > self.kept_rank[rows[todo]]
            done = todo[sampled]
            positions[done] = self.kept[self.kept_rank[rows[done]]] + steps
            todo = todo[~sampled]
            symbols, ranks = self.symbol_and_rank(rows[todo])
            rows[todo] = self.before[symbols] + ranks
            steps += 1
        return which, positions
