"""A full-text index of word sequences: suffix array, wavelet matrix, backward search.

Plain numpy over one shard's words, whose size the caller bounds. All patterns are searched and all
occurrences located in step, as arrays.
"""

from __future__ import annotations

import numpy as np

SAMPLE = 8


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Order of all suffixes, by doubling the length over which they are ranked. Few arrays of its size are held at a time."""
    n = len(symbols)
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64, copy=False)
    length = 1
    while True:
        both = rank * (n + 1)
        if length < n:
            both[:-length] += rank[length:] + 1
        del rank
        order = np.argsort(both, kind="stable")
        both = both[order]
        new = np.concatenate([[False], both[1:] != both[:-1]])[:n]
        del both
        steps = np.cumsum(new)
        if n == 0 or steps[-1] == n - 1:
            return order
        rank = np.empty(n, np.int64)
        rank[order] = steps
        length *= 2


class FMIndex:
    """Index of runs of words (ids from 1 up). No occurrence spans two runs."""

    def __init__(self, runs: list[np.ndarray]):
        lengths = np.array([len(r) for r in runs], np.int64)
        starts = np.cumsum(lengths + 1) - (lengths + 1)
        n = int((lengths + 1).sum())
        words = np.zeros(n, np.int32)
        gap = np.zeros(n, bool)
        gap[starts + lengths] = True
        words[~gap] = np.concatenate(runs)
        # Each run's end sorts differently, so that comparing suffixes stops there.
        symbols = words + np.int64(len(runs))
        symbols[gap] = np.arange(len(runs))
        del gap
        order = suffix_array(symbols)
        del symbols
        last = words[order - 1]  # 0 before a run; the text's last symbol ends a run too
        self.first = np.concatenate([[0], np.cumsum(np.bincount(words, minlength=1))])
        # Positions are kept for each SAMPLE-th word and each run's first, so a walk back stays in its run.
        kept = np.zeros(n, bool)
        kept[::SAMPLE] = True
        kept[starts] = True
        self.sampled = kept[order]
        self.sample_rank = np.cumsum(np.concatenate([[0], self.sampled]), dtype=np.int32)
        self.sample_at = order[self.sampled]
        del order, kept
        # Wavelet matrix of the last column: per level the bits, their running count and the zeros.
        self.bits = max(1, int(words.max(initial=0)).bit_length())
        del words
        self.levels, column = [], last
        del last
        for level in reversed(range(self.bits)):
            bit = (column >> level) & 1
            ones = np.zeros(n + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.levels.append((level, ones, n - int(ones[-1])))
            column = np.concatenate([column[bit == 0], column[bit == 1]])
        self.n = n

    def rank(self, word: np.ndarray, upto: np.ndarray) -> np.ndarray:
        """How often each word is in the last column before row ``upto``."""
        begin, end = np.zeros_like(upto), upto
        for level, ones, zeros in self.levels:
            bit = ((word >> level) & 1).astype(bool)
            b, e = ones[begin], ones[end]
            begin, end = np.where(bit, zeros + b, begin - b), np.where(bit, zeros + e, end - e)
        return end - begin

    def access(self, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(word in the last column, its rank there) of each row."""
        word, begin, at = np.zeros_like(row), np.zeros_like(row), row
        for level, ones, zeros in self.levels:
            bit = (ones[at + 1] - ones[at]).astype(bool)
            word = word | (bit.astype(np.int64) << level)
            b, e = ones[begin], ones[at]
            begin, at = np.where(bit, zeros + b, begin - b), np.where(bit, zeros + e, at - e)
        return word, at - begin

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [low, high) whose suffixes start with each pattern (rows of ids, 0 at the left as filler)."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n, np.int64)
        live = np.arange(len(patterns))
        most = len(self.first) - 2  # the highest word of this index
        for k in reversed(range(patterns.shape[1])):
            word = patterns[live, k]
            go = word > 0
            known = word <= most
            high[live[go & ~known]] = 0
            live, word = live[go & known], word[go & known]
            low[live] = self.first[word] + self.rank(word, low[live])
            high[live] = self.first[word] + self.rank(word, high[live])
            live = live[low[live] < high[live]]
            if not len(live):
                break
        return low, np.maximum(low, high)

    def locate(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(pattern number, position) of all occurrences: walk back to a kept position."""
        number = high - low
        which = np.repeat(np.arange(len(low)), number)
        row = np.arange(int(number.sum())) + np.repeat(low - (np.cumsum(number) - number), number)
        at, steps, live = np.zeros_like(row), np.zeros_like(row), np.arange(len(row))
        while len(live):
            kept = self.sampled[row[live]]
            done = live[kept]
            at[done] = self.sample_at[self.sample_rank[row[done]]] + steps[done]
            live = live[~kept]
            word, before = self.access(row[live])
            row[live] = self.first[word] + before
            steps[live] += 1
        return which, at
