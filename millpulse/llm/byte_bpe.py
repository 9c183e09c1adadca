"""Token ids of whole texts with a byte-level BPE of the tokenizers library, each distinct word encoded once.

The library's own pre-tokenizer decides what is a letter, a number or white
space; its model encodes the words.  Only the splitting of a block of texts into
words is done here, on arrays: the fixed byte-level rule
``'s|'t|'re|'ve|'m|'ll|'d| ?L+| ?N+| ?[^ L N space]+|space+(?!not space)|space+``.
Texts that hold one of the tokenizer's added tokens go to the library whole.
"""

from __future__ import annotations

import re

import numpy as np
from tokenizers import Tokenizer

from .common import spread
from .textops import Rolling, mix

SPACE, LETTER, NUMBER, OTHER, UNKNOWN = range(5)
_loaded: dict[str, ByteBpe] = {}


def load(path: str) -> ByteBpe:
    """One encoder per file and worker process."""
    if path not in _loaded:
        _loaded[path] = ByteBpe(path)
    return _loaded[path]


def byte_symbols() -> list[str]:
    """The characters that stand for the 256 bytes: printable ones for themselves, the rest from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    out = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}
    return [out[b] for b in range(256)]


class ByteBpe:
    #: Distinct words kept by a worker; beyond it the store starts anew.
    MOST_WORDS = 150_000

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.pre, self.model = self.tokenizer.pre_tokenizer, self.tokenizer.model
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        self.symbols = byte_symbols()
        self.kind = np.full(0x110000, UNKNOWN, dtype=np.uint8)
        self.value = mix(np.arange(1, 0x110001, dtype=np.uint64))
        self.clear()

    def clear(self) -> None:
        """Forget all words."""
        self.place: dict[int, int] = {}
        self.ids, self.used = np.zeros(1 << 18, dtype=np.uint32), 0
        self.start, self.length = np.zeros(1 << 16, dtype=np.int64), np.zeros(1 << 16, dtype=np.int64)

    def _classify(self, points: np.ndarray) -> None:
        """Ask the library's pre-tokenizer which class a character joins."""
        for p in points.tolist():
            ch = chr(p)
            joins = lambda before: len(self.pre.pre_tokenize_str(before + ch)) == 1  # noqa: B023, E731
            self.kind[p] = LETTER if joins("a") else NUMBER if joins("1") else OTHER if joins("!") else SPACE

    def words(self, points: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """Starts of the words of a block of texts (code points, text offsets)."""
        n = len(points)
        kind = self.kind[points]
        if (kind == UNKNOWN).any():
            self._classify(np.unique(points[kind == UNKNOWN]))
            kind = self.kind[points]
        new = np.ones(n, dtype=bool)
        new[1:] = kind[1:] != kind[:-1]
        new[offs[:-1][offs[:-1] < n]] = True
        begin = np.flatnonzero(new)
        end = np.append(begin[1:], n)
        text_end = np.zeros(n + 1, dtype=bool)
        text_end[offs] = True
        last = text_end[end]  # the run ends its text
        what = kind[begin]
        start = np.zeros(n + 1, dtype=bool)
        gap = what == SPACE
        start[begin[gap & last]] = True
        inner = gap & ~last
        start[end[inner] - 1] = True
        start[begin[inner]] = True
        # a run that is not space takes a plain space before it
        after = np.zeros(len(begin), dtype=bool)
        after[1:] = inner[:-1] & (points[end[:-1] - 1] == 0x20)
        start[begin[~gap & ~after]] = True
        # contractions: a lone apostrophe without a space, then a suffix
        quote = np.flatnonzero((what == OTHER) & ~after & ~last & (end - begin == 1) & (points[begin] == 0x27))
        quote = quote[what[quote + 1] == LETTER] if len(quote) else quote
        if len(quote):
            padded = np.append(points, [0, 0])
            run = end[quote + 1] - begin[quote + 1]
            a, b = padded[begin[quote] + 1], padded[begin[quote] + 2]
            one = np.isin(a, [ord(c) for c in "stmd"])
            two = (run > 1) & (((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l"))))
            size = np.where(one, 1, np.where(two, 2, 0))
            q, size, run = begin[quote][size > 0], size[size > 0], run[size > 0]
            start[q + 1] = False
            start[(q + 1 + size)[run > size]] = True
        return np.flatnonzero(start[:n])

    def _learn(self, keys: list[int], words: list[str]) -> None:
        symbol, tokenize = self.symbols.__getitem__, self.model.tokenize
        ids, many = [], []
        for word in words:
            got = tokenize("".join(map(symbol, word.encode())))
            many.append(len(got))
            ids += [t.id for t in got]
        k, n = len(self.place), len(words)
        while self.used + len(ids) > len(self.ids):
            self.ids = np.append(self.ids, self.ids)
        while k + n > len(self.start):
            self.start, self.length = np.append(self.start, self.start), np.append(self.length, self.length)
        self.ids[self.used : self.used + len(ids)] = ids
        self.length[k : k + n] = many
        self.start[k : k + n] = self.used + np.cumsum(many) - many
        self.used += len(ids)
        self.place.update(zip(keys, range(k, k + n), strict=True))

    def encode(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of the texts of a block of UTF-8."""
        block = data.tobytes().decode()
        points = np.frombuffer(block.encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
        # characters before each byte offset
        lead = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
        at = lead[offs]
        if not len(points):
            return np.zeros(0, dtype=np.uint32), np.zeros(len(offs), dtype=np.int64)
        start = self.words(points, at)
        end = np.append(start[1:], len(points))
        key = Rolling(self.value[points]).slices(start, end)
        distinct, first, which = np.unique(key, return_index=True, return_inverse=True)
        if len(self.place) + len(distinct) > self.MOST_WORDS:
            self.clear()
        place = self.place
        row = np.array([place.get(k, -1) for k in distinct.tolist()], dtype=np.int64)
        missing = np.flatnonzero(row < 0)
        if len(missing):
            row[missing] = len(self.place) + np.arange(len(missing))
            f = first[missing]
            self._learn(distinct[missing].tolist(), [block[a:b] for a, b in zip(start[f].tolist(), end[f].tolist(), strict=True)])
        row = row[which]
        many = self.length[row]
        owner, k = spread(many)
        ids = self.ids[self.start[row][owner] + k]
        word_ends = np.concatenate(([0], np.cumsum(many)))
        return ids, word_ends[np.searchsorted(start, at)]

    def encode_column(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As ``encode``; texts with added tokens are encoded by the library."""
        ids, ends = self.encode(data, offs)
        if self.added is None or not self.added.search(data.tobytes().decode()):
            return ids, ends
        parts = [ids[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
        for d in range(len(parts)):
            text = data[offs[d] : offs[d + 1]].tobytes().decode()
            if self.added.search(text):
                parts[d] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
        return np.concatenate(parts), np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int64)


def encode_texts(path: str, texts: list[str]) -> list[list[int]]:
    """Ids of each text (for tests and small lists)."""
    raw = [t.encode() for t in texts]
    offs = np.concatenate(([0], np.cumsum([len(t) for t in raw]))).astype(np.int64)
    ids, ends = load(path).encode_column(np.frombuffer(b"".join(raw), dtype=np.uint8), offs)
    return [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:], strict=True)]
