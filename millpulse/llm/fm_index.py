"""A full-text index of one shard: wavelet matrix of its Burrows-Wheeler sequence, sampled suffix positions."""

from __future__ import annotations

import numpy as np

from .suffix import suffix_array


class FMIndex:
    """Counts and locates phrases in a sequence of symbols 1..sigma-1 (0 is taken by the end).

    All methods work on arrays of queries at once.
    """

    def __init__(self, symbols: np.ndarray, sigma: int, sample: int = 8):
        t = np.append(symbols, 0).astype(np.int64)
        n = len(t)
        sa = suffix_array(t, sigma)
        bwt = t[sa - 1]
        self.n = n
        self.before = np.concatenate(([0], np.cumsum(np.bincount(t, minlength=sigma))))
        self.sampled = sa % sample == 0
        self.sample_rank = np.concatenate(([0], np.cumsum(self.sampled)))
        self.sample_at = sa[self.sampled]
        self.bits: list[np.ndarray] = []  # ones before each place, per level from the top bit
        self.zeros: list[int] = []
        self.levels = max(1, int(sigma - 1).bit_length())
        seq = bwt
        for level in range(self.levels - 1, -1, -1):
            bit = (seq >> level) & 1
            self.bits.append(np.concatenate(([0], np.cumsum(bit))))
            self.zeros.append(n - int(self.bits[-1][-1]))
            seq = np.concatenate((seq[bit == 0], seq[bit == 1]))

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        low, high = np.zeros_like(at), at
        for k, (ones, zeros) in enumerate(zip(self.bits, self.zeros, strict=True)):
            one = (symbol >> (self.levels - 1 - k)) & 1 == 1
            low = np.where(one, zeros + ones[low], low - ones[low])
            high = np.where(one, zeros + ones[high], high - ones[high])
        return high - low

    def step(self, row: np.ndarray) -> np.ndarray:
        """The row of the suffix that starts one place earlier (symbol and rank in one descent)."""
        at, low, symbol = row, np.zeros_like(row), np.zeros_like(row)
        for ones, zeros in zip(self.bits, self.zeros, strict=True):
            one = ones[at + 1] > ones[at]
            symbol = symbol * 2 + one
            at = np.where(one, zeros + ones[at], at - ones[at])
            low = np.where(one, zeros + ones[low], low - ones[low])
        return self.before[symbol] + at - low

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges [low, high) of phrases of one length, by backward search."""
        low = np.zeros(len(phrases), dtype=np.int64)
        high = np.full(len(phrases), self.n, dtype=np.int64)
        alive = np.arange(len(phrases))
        for k in range(phrases.shape[1] - 1, -1, -1):
            c = phrases[alive, k]
            a = self.before[c] + self.rank(c, low[alive])
            b = self.before[c] + self.rank(c, high[alive])
            low[alive], high[alive] = a, b
            alive = alive[a < b]
            if not len(alive):
                break
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows: steps back to the next sampled one."""
        row, steps = rows.copy(), np.zeros(len(rows), dtype=np.int64)
        walk = np.flatnonzero(~self.sampled[row])
        while len(walk):
            row[walk] = self.step(row[walk])
            steps[walk] += 1
            walk = walk[~self.sampled[row[walk]]]
        return self.sample_at[self.sample_rank[row]] + steps
