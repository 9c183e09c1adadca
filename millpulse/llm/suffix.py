"""Suffix arrays by induced sorting, on numpy arrays.

The order of the suffixes that start at leftmost-smaller positions is found by
sorting and naming the substrings between such positions and sorting the names'
sequence in turn; all other suffixes are induced from them.  Induction goes
bucket by bucket: the suffixes that a whole bucket induces are found, and dealt
to their buckets, in one step.  That needs a loop over the alphabet, so a
sequence of names over more than ``MAX_ALPHABET`` symbols (a deeper level of
the recursion) is sorted by rank doubling over the positions still undecided.
"""

from __future__ import annotations

import numpy as np

from .textops import Rolling, mix

MAX_ALPHABET = 1024


def smaller_types(t: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than their right neighbour; the last symbol is the least and unique."""
    n = len(t)
    change = np.flatnonzero(t[1:] != t[:-1])
    up = t[change] < t[change + 1]
    return np.repeat(np.append(up, True), np.diff(np.concatenate(([-1], change, [n - 1]))))


def _join(parts: list[np.ndarray]) -> np.ndarray:
    if len(parts) == 1:
        return parts[0]
    return np.concatenate(parts) if parts else np.zeros(0, dtype=np.int32)


def _deal(pred: np.ndarray, symbol: np.ndarray, to: list[list[np.ndarray]]) -> None:
    order = np.argsort(symbol, kind="stable")
    symbol, pred = symbol[order], pred[order]
    cuts = np.flatnonzero(np.diff(symbol)) + 1
    for part, at in zip(np.split(pred, cuts), np.concatenate(([0], cuts)), strict=True):
        to[symbol[at]].append(part)


def induce(code: np.ndarray, sigma: int, seeds: np.ndarray) -> np.ndarray:
    """The order of all suffixes, given that of the leftmost-smaller ones.

    ``code`` is 2 * symbol + (1 for a smaller-type position); ``seeds`` are
    sorted by symbol at least, and their order within a symbol is taken over.
    """
    seed_symbol = code[seeds] >> 1
    seed_at = np.searchsorted(seed_symbol, np.arange(sigma + 1))
    larger: list[np.ndarray] = []
    to: list[list[np.ndarray]] = [[] for _ in range(sigma)]
    for c in range(sigma):
        grown = [_join(to[c])]
        while len(grown[-1]):  # runs of one symbol induce into their own bucket
            pred = grown[-1] - 1
            grown.append(pred[code[pred] == 2 * c])
        larger.append(_join(grown))
        to[c] = []
        pred = np.concatenate((larger[c], seeds[seed_at[c] : seed_at[c + 1]])) - 1
        if len(pred):
            got = code[pred]
            take = (got & 1 == 0) & (got > 2 * c)
            if take.any():
                _deal(pred[take], got[take] >> 1, to)
    smaller: list[np.ndarray] = [larger[0][:0]] * sigma
    to[0].append(np.array([len(code) - 1], dtype=np.int32))
    for c in range(sigma - 1, -1, -1):
        grown = [_join(to[c])]
        while len(grown[-1]):
            pred = grown[-1] - 1
            grown.append(pred[(code[pred] == 2 * c + 1) & (pred >= 0)])
        smaller[c] = _join(grown)
        to[c] = []
        pred = np.concatenate((smaller[c], larger[c][::-1])) - 1
        if len(pred):
            got = code[pred]
            take = (got & 1 == 1) & (got < 2 * c) & (pred >= 0)
            if take.any():
                _deal(pred[take], got[take] >> 1, to)
    return np.concatenate([x for c in range(sigma) for x in (larger[c], smaller[c][::-1])])


def rank_doubling(t: np.ndarray) -> np.ndarray:
    """Suffix order of a sequence whose last symbol is the least and unique."""
    n = len(t)
    order = np.argsort(t, kind="stable")
    v = t[order]
    head = np.flatnonzero(np.concatenate(([True], v[1:] != v[:-1])))
    size = np.diff(np.append(head, n))
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.repeat(head, size)
    open_ = order[np.repeat(size > 1, size)]
    h = 1
    while len(open_):
        first = rank[open_]
        key = first * n + rank[open_ + h]
        by = np.argsort(key, kind="stable")
        key, first, open_ = key[by], first[by], open_[by]
        new = np.concatenate(([True], key[1:] != key[:-1]))
        group = np.concatenate(([True], first[1:] != first[:-1]))
        at = np.arange(len(key))
        rank[open_] = first + np.maximum.accumulate(np.where(new, at, 0)) - np.maximum.accumulate(np.where(group, at, 0))
        head = np.flatnonzero(new)
        size = np.diff(np.append(head, len(key)))
        open_ = open_[np.repeat(size > 1, size)]
        h *= 2
    out = np.empty(n, dtype=np.int64)
    out[rank] = np.arange(n)
    return out


def suffix_array(t: np.ndarray, sigma: int) -> np.ndarray:
    """Order of the suffixes of ``t`` (symbols 0..sigma-1; the last one, 0, occurs nowhere else)."""
    n = len(t)
    if sigma > MAX_ALPHABET or n < 64:
        return rank_doubling(t.astype(np.int64))
    small = smaller_types(t)
    code = (t.astype(np.int32) * 2 + small).astype(np.int16 if sigma < 1 << 14 else np.int32)
    is_lms = small.copy()
    is_lms[0] = False
    is_lms[1:] &= ~small[:-1]
    lms = np.flatnonzero(is_lms).astype(np.int32)
    first = induce(code, sigma, lms[np.argsort(t[lms], kind="stable")])
    ordered = first[is_lms[first]]
    place = np.empty(n, dtype=np.int32)
    place[lms] = np.arange(len(lms), dtype=np.int32)
    ends = np.append(lms[1:] + 1, n).astype(np.int64)
    which = place[ordered]
    same = Rolling(mix(t.astype(np.uint64) + np.uint64(1))).slices(ordered.astype(np.int64), np.maximum(ends[which], ordered + 1))
    name = np.concatenate(([0], np.cumsum(same[1:] != same[:-1])))
    if name[-1] + 1 < len(lms):
        names = np.empty(len(lms), dtype=np.int64)
        names[which] = name
        ordered = lms[suffix_array(names, int(name[-1]) + 1)]
    return induce(code, sigma, ordered)


def previous_in_order(sa: np.ndarray) -> np.ndarray:
    """For each position the one whose suffix comes just before its own; -1 for the first."""
    out = np.empty(len(sa), dtype=np.int64)
    out[sa[0]] = -1
    out[sa[1:]] = sa[:-1]
    return out
