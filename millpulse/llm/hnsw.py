"""A hierarchical navigable small-world graph over unit vectors, searched for many queries at once.

Nodes are numbered by falling level, so layer l holds the first ``sizes[l]``
nodes.  Layers are built from the top; nodes are inserted in batches that grow
with the layer.  A node's neighbours are chosen for diversity (a candidate is
taken if it is nearer to the node than to any neighbour taken before; free
places go to the nearest of the rest), which keeps tight clusters connected to
the rest of the graph.
"""

from __future__ import annotations

import numpy as np

DEGREE = 16
BUILD_BEAM = 48
EXPAND = 4
#: Entries of the visited table of a search, at most.
VISITED = 1 << 25


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 in double precision, without overflow."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def levels(uniform: np.ndarray, degree: int = DEGREE) -> np.ndarray:
    return np.floor(-np.log(np.maximum(uniform, 1e-12)) / np.log(degree)).astype(np.int64)


def choose(center: np.ndarray, ids: np.ndarray, sims: np.ndarray, vectors: np.ndarray, most: int) -> np.ndarray:
    """(rows, most) neighbours among each row's candidates (-1: none), diverse ones first."""
    order = np.argsort(-sims, axis=1, kind="stable")
    ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
    v = vectors[np.maximum(ids, 0)]
    between = np.einsum("rkd,rjd->rkj", v, v)
    rows, k = ids.shape
    taken = np.zeros((rows, k), dtype=bool)
    for c in range(k):
        close = (taken & (between[:, c, :] > sims[:, c, None])).any(axis=1)
        taken[:, c] = (ids[:, c] >= 0) & ~close & (taken.sum(axis=1) < most)
    rank = np.where(taken, 0, np.where(ids >= 0, 1, 2))
    first = np.argsort(rank, axis=1, kind="stable")[:, :most]
    out = np.take_along_axis(ids, first, 1)
    if out.shape[1] < most:
        out = np.pad(out, ((0, 0), (0, most - out.shape[1])), constant_values=-1)
    return out


class Hnsw:
    def __init__(self, vectors: np.ndarray, level: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM):
        """``vectors``: unit rows, ``level`` falling."""
        self.vectors = np.ascontiguousarray(vectors, dtype=np.float32)
        self.sizes = [int((level >= x).sum()) for x in range(int(level[0]) + 1)]
        self.links = [np.full((n, degree * (1 if x else 2)), -1, dtype=np.int32) for x, n in enumerate(self.sizes)]
        for layer in range(len(self.sizes) - 1, -1, -1):
            done = 1
            while done < self.sizes[layer]:
                end = min(self.sizes[layer], done + max(32, min(done // 4, 1024)))
                self._insert(layer, done, end, beam)
                done = end

    @classmethod
    def stored(cls, vectors: np.ndarray, sizes: list[int], links: list[np.ndarray]) -> Hnsw:
        out = cls.__new__(cls)
        out.vectors, out.sizes, out.links = np.ascontiguousarray(vectors, dtype=np.float32), sizes, links
        return out

    def _insert(self, layer: int, a: int, b: int, beam: int) -> None:
        most = self.links[layer].shape[1]
        fresh = self.vectors[a:b]
        ids, sims = self.search(fresh, beam, layer, a)
        own = fresh @ fresh.T
        np.fill_diagonal(own, -2)
        k = min(beam, b - a)
        near = np.argpartition(-own, k - 1, axis=1)[:, :k]
        sims = np.concatenate((sims, np.take_along_axis(own, near, 1)), axis=1)
        ids = np.concatenate((ids, np.where(np.take_along_axis(own, near, 1) > -2, near + a, -1)), axis=1)
        got = choose(fresh, ids, np.where(ids >= 0, sims, -2), self.vectors, max(most // 2, 1))
        self.links[layer][a:b, : got.shape[1]] = got
        # and back: each chosen node reconsiders its neighbours
        to, back = got.reshape(-1), np.repeat(np.arange(a, b), got.shape[1])
        to, back = to[to >= 0], back[to >= 0]
        sim = np.einsum("ij,ij->i", self.vectors[to], self.vectors[back])
        order = np.lexsort((-sim, to))
        to, back = to[order], back[order]
        node, first, many = np.unique(to, return_index=True, return_counts=True)
        place = np.arange(len(to)) - np.repeat(first, many)
        room = min(int(many.max()), 2 * most)
        add = np.full((len(node), room), -1, dtype=np.int64)
        ok = place < room
        add[np.repeat(np.arange(len(node)), many)[ok], place[ok]] = back[ok]
        for s in range(0, len(node), 512):
            n = node[s : s + 512]
            both = np.sort(np.concatenate((self.links[layer][n], add[s : s + 512]), axis=1), axis=1)[:, ::-1]
            both[:, 1:][both[:, 1:] == both[:, :-1]] = -1
            sims = np.einsum("rd,rkd->rk", self.vectors[n], self.vectors[np.maximum(both, 0)])
            self.links[layer][n] = choose(self.vectors[n], both, np.where(both >= 0, sims, -2), self.vectors, most)

    def search(self, queries: np.ndarray, beam: int, layer: int = 0, limit: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids, similarities) of each query's beam in a layer (-1: place not filled)."""
        limit = self.sizes[layer] if limit is None else limit
        step = int(np.clip(VISITED // max(1, limit), 8, 256))
        parts = []
        for s in range(0, len(queries), step):
            q = np.ascontiguousarray(queries[s : s + step], dtype=np.float32)
            entry = np.zeros((len(q), 1), dtype=np.int64)
            for x in range(len(self.sizes) - 1, layer, -1):
                entry = self._search_layer(q, entry, x, 1, min(limit, self.sizes[x]))[0]
            parts.append(self._search_layer(q, entry, layer, min(beam, limit), limit))
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True))

    def _search_layer(self, q: np.ndarray, entry: np.ndarray, layer: int, beam: int, limit: int) -> tuple[np.ndarray, np.ndarray]:
        n, links = len(q), self.links[layer]
        seen = np.zeros((n, limit), dtype=bool)
        ids = np.full((n, beam), -1, dtype=np.int64)
        sims = np.full((n, beam), -2, dtype=np.float32)
        closed = np.ones((n, beam), dtype=bool)
        ids[:, :1] = entry
        sims[:, 0] = np.einsum("qd,qd->q", q, self.vectors[entry[:, 0]])
        closed[:, 0] = False
        seen[np.arange(n), entry[:, 0]] = True
        active, width = np.arange(n), min(EXPAND, beam)
        while len(active):
            s = np.where(closed[active], np.float32(-3), sims[active])
            pick = np.argpartition(-s, width - 1, axis=1)[:, :width]
            ok = np.take_along_axis(s, pick, 1) > -2.5
            some = ok.any(axis=1)
            active, pick, ok = active[some], pick[some], ok[some]
            if not len(active):
                break
            row = active[:, None]
            closed[row, pick] = True
            node = ids[row, pick]
            near = np.where(ok[:, :, None], links[node], -1).reshape(len(active), -1)
            near[near >= limit] = -1
            near = np.sort(near, axis=1)
            near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
            near[(near >= 0) & seen[row, np.maximum(near, 0)]] = -1
            r, c = np.nonzero(near >= 0)
            at = near[r, c]
            seen[active[r], at] = True
            found = np.full(near.shape, -2, dtype=np.float32)
            found[r, c] = np.einsum("xd,xd->x", q[active[r]], self.vectors[at])
            all_ids = np.concatenate((ids[active], near), axis=1)
            all_sims = np.concatenate((sims[active], found), axis=1)
            all_closed = np.concatenate((closed[active], near < 0), axis=1)
            best = np.argpartition(-all_sims, beam - 1, axis=1)[:, :beam]
            ids[active], sims[active], closed[active] = (np.take_along_axis(x, best, 1) for x in (all_ids, all_sims, all_closed))
        return ids, sims

    def within(self, queries: np.ndarray, least: float, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, node) pairs found with similarity of at least ``least``: a beam full of them is widened."""
        pending, out_q, out_n = np.arange(len(queries)), [], []
        while len(pending):
            ids, sims = self.search(queries[pending], beam)
            hit = (ids >= 0) & (sims >= least)
            full = hit.all(axis=1) & (ids.shape[1] < self.sizes[0])
            q, c = np.nonzero(hit & ~full[:, None])
            out_q.append(pending[q])
            out_n.append(ids[q, c])
            pending, beam = pending[full], beam * 4
        return np.concatenate(out_q or [np.zeros(0, np.int64)]), np.concatenate(out_n or [np.zeros(0, np.int64)])
