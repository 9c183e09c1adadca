"""Brute-force versions of the operators' contracts, on Python strings."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WS = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

#: Rows that every operator has to take: nulls, blanks, ties, repeated rows and ids, odd characters.
ODD = [
    (None, "a text without an id, long enough to have a few words in it", "en", None, None),
    (None, None, None, None, None),
    (900001, None, "en", "s", 0),
    (900002, "", "en", "s", 0),
    (900003, " \n\t \n", None, "s", 0),
    (900004, "one", "en", "s", 3),
    (900004, "one", "en", "s", 3),
    (900005, "12 34 !! ?", "de", "s", 10),
    (900006, "naïve café 日本語 \U0001f600 ΑΒΓ don't   x<|endoftext|>y", "fr", "s", 10),
]


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


def roots(nodes, links):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingle_set(text, w=5):
    words = WS.findall(lower(text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + w]) for i in range(max(1, len(words) - w + 1)))


def near_groups(texts: list) -> list[int]:
    """For each text the first index of its group."""
    sets = [shingle_set(t) for t in texts]
    holders = defaultdict(set)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].add(i)
    pairs = {(a, b) for h in holders.values() for a in h for b in h if a < b}
    links = [(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    found = roots(range(len(texts)), links)
    return [found[i] for i in range(len(texts))]


def repeated_cover(items: list[list], window: int) -> list[list[bool]]:
    """Which units are covered by a window that starts anywhere else."""
    count = Counter(tuple(x[i : i + window]) for x in items for i in range(len(x) - window + 1))
    out = []
    for x in items:
        gone = [False] * len(x)
        for i in range(len(x) - window + 1):
            if count[tuple(x[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        out.append(gone)
    return out


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def contamination(texts: list, items: list[tuple], window: int = 10) -> list[tuple]:
    phrases = defaultdict(set)
    for ident, text in items:
        words = ALNUM.findall(lower(text or ""))
        if words:
            for i in range(max(1, len(words) - window + 1)):
                phrases[tuple(words[i : i + window])].add("" if ident is None else str(ident))
    out = []
    for text in texts:
        words, hit, found = ALNUM.findall(lower(text or "")), set(), set()
        for size in {len(p) for p in phrases}:
            for i in range(len(words) - size + 1):
                if (p := tuple(words[i : i + size])) in phrases:
                    hit |= set(range(i, i + size))
                    found |= phrases[p]
        out.append((len(words), len(hit), len(found), sha(",".join(sorted(found)).encode()), bool(hit)))
    return out


def without_later_lines(texts: list, min_lines: int, min_words: int) -> list:
    """Texts in document order without the later copies of runs of so many lines, or of fewer with so many words."""
    seen, out, gone = set(), [], []
    sequences = []
    for t in texts:
        lines = [] if t is None else t.split("\n")
        sequences.append([(i, x) for i, x in enumerate(lines) if x.strip()])
    for d, seq in enumerate(sequences):
        mine = set()
        for p in range(len(seq)):
            for depth in range(1, min_lines + 1):
                run = tuple(x for _, x in seq[p : p + depth])
                if len(run) == depth and (depth == min_lines or sum(len(x.split()) for x in run) >= min_words):
                    if run in seen:
                        mine |= set(range(p, p + depth))
                    seen.add(run)
        gone.append(mine)
    for t, seq, mine in zip(texts, sequences, gone, strict=True):
        drop = {seq[p][0] for p in mine}
        out.append(None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in drop))
    return out
