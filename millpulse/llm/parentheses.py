"""Trees as balanced parentheses, with a range min-max index over blocks of excess.

A tree's nodes in preorder are the opening parentheses.  The excess (opened less
closed) is kept by its least value a block, and a tree of minima above the blocks.
``find_close`` climbs to the first block that falls below a node's excess and
looks into it.  All operations take arrays of nodes.
"""

from __future__ import annotations

import numpy as np

BLOCK = 64


class Parentheses:
    """``signs``: 1 for an opening, -1 for a closing parenthesis; a balanced sequence of one tree."""

    def __init__(self, signs: np.ndarray):
        self.signs = signs.astype(np.int8)
        self.excess = np.cumsum(self.signs, dtype=np.int64)
        self.opens = np.flatnonzero(self.signs > 0)
        self.rank = np.cumsum(self.signs > 0, dtype=np.int64)
        blocks = -(-len(signs) // BLOCK)
        size = 1 << max(0, (blocks - 1).bit_length())
        far = np.iinfo(np.int64).max
        padded = np.full(size * BLOCK, far, dtype=np.int64)
        padded[: len(signs)] = self.excess
        self.blocks = padded.reshape(size, BLOCK)
        #: minima[size + b] is that of block b, minima[k] that of its two children
        self.minima = np.full(2 * size, far, dtype=np.int64)
        self.minima[size:] = self.blocks.min(axis=1)
        at = size
        while at > 1:
            pairs = self.minima[at : 2 * at].reshape(-1, 2)
            self.minima[at // 2 : at] = pairs.min(axis=1)
            at //= 2
        self.size = size

    def find_close(self, nodes: np.ndarray) -> np.ndarray:
        """Places of the closing parentheses of nodes (preorder numbers)."""
        out = np.empty(len(nodes), dtype=np.int64)
        step = 1 << 14  # nodes at a time: one row of BLOCK values each
        for a in range(0, len(nodes), step):
            out[a : a + step] = self._find_close(self.opens[nodes[a : a + step]])
        return out

    def _find_close(self, places: np.ndarray) -> np.ndarray:
        below = self.excess[places] - 1
        inside = self.blocks[places // BLOCK] <= below[:, None]
        inside &= np.arange(BLOCK)[None, :] > (places % BLOCK)[:, None]
        here = inside.any(axis=1)
        out = places // BLOCK * BLOCK + inside.argmax(axis=1)
        rest = np.flatnonzero(~here)
        if len(rest):
            target = below[rest]
            k = self.size + places[rest] // BLOCK
            # up to the first right neighbour that falls low enough, then down to its first such block
            up = np.ones(len(rest), dtype=bool)
            while up.any():
                right = up & (k % 2 == 0) & (self.minima[np.minimum(k + 1, len(self.minima) - 1)] <= target)
                k = np.where(right, k + 1, np.where(up, k // 2, k))
                up &= ~right
            while (k < self.size).any():
                left = self.minima[np.minimum(2 * k, len(self.minima) - 1)] <= target
                k = np.where(k < self.size, 2 * k + np.where(left, 0, 1), k)
            block = k - self.size
            out[rest] = block * BLOCK + (self.blocks[block] <= target[:, None]).argmax(axis=1)
        return out

    def ends(self) -> np.ndarray:
        """For every node the preorder number after its subtree's last node."""
        return self.rank[self.find_close(np.arange(len(self.opens)))]

    def pairs(self) -> np.ndarray:
        """For every node whether it is a leaf pair: closed right after it opens."""
        after = np.append(self.signs[1:], 0)
        return after[self.opens] < 0


def range_sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums over every node's subtree, by one cumulative array."""
    total = np.concatenate(([0], np.cumsum(values)))
    return total[ends] - total[np.arange(len(ends))]


def range_minima(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Minima over every node's subtree, by minima over powers of two."""
    start, length = np.arange(len(ends)), ends - np.arange(len(ends))
    level = np.frexp(length.astype(np.float64))[1] - 1
    out, table = np.empty_like(values), values
    for k in range(int(level.max(initial=0)) + 1):
        at = np.flatnonzero(level == k)
        out[at] = np.minimum(table[start[at]], table[ends[at] - (1 << k)])
        if len(table) > 1 << k:
            table = np.minimum(table[: len(table) - (1 << k)], table[1 << k :])
    return out
