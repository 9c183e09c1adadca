"""Array helpers on blocks of texts: word spans, rolling hashes, winnowing.

All functions work on one block of concatenated UTF-8 texts (``data``: uint8,
``offs``: n+1 text offsets), as they lie in an Arrow string column.  Words and
hashes are found for the whole block at once, so Python does no work per word.
Hashes are 64-bit polynomial hashes with random byte values, finished by an
avalanche step; they are the same in every process and on every machine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15 | 1)
_WORD_BASE = _U(0xD1342543DE82EF95 | 1)


def _inverse(a: int) -> int:
    return pow(a, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Avalanche step of a 64-bit hash (a bijection)."""
    x = x ^ (x >> _U(31))
    x = x * _U(0x7FB5D329728EA185)
    x ^= x >> _U(27)
    x *= _U(0x81DADEF4BC2DD44D)
    x ^= x >> _U(33)
    return x


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)
_powers: dict[int, np.ndarray] = {}
#: Powers that a worker keeps; a longer text has its own computed and dropped.
KEPT_POWERS = (1 << 19) + (1 << 16)


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept up to a bound."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        out = np.full(max(n, 1 << 16), _U(base))
        out[0] = 1
        have = np.multiply.accumulate(out)
        if len(have) <= KEPT_POWERS:
            _powers[base] = have
    return have[:n]


class Rolling:
    """Hash of any slice ``[s, e)`` of a sequence of uint64 values."""

    def __init__(self, values: np.ndarray, base: np.uint64 = _BASE):
        n = len(values)
        self.base = int(base)
        self.prefix = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(values * powers(self.base, n), out=self.prefix[1:])
        self.back = powers(_inverse(self.base), n + 1)

    def slices(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of each slice; slices of different lengths do not compare equal."""
        h = (self.prefix[end] - self.prefix[start]) * self.back[start]
        return mix(h + (end - start).astype(np.uint64) * _U(0xC2B2AE3D27D4EB4F))

    def every(self, k: int) -> np.ndarray:
        """Hash of every slice of k values."""
        n = len(self.prefix) - k
        if n <= 0:
            return np.zeros(0, dtype=np.uint64)
        h = (self.prefix[k:] - self.prefix[:n]) * self.back[:n]
        return mix(h + _U(k * 0xC2B2AE3D27D4EB4F & (1 << 64) - 1))


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """Table of 256 flags, true in the given inclusive ranges."""
    out = np.zeros(256, dtype=bool)
    for a, b in ranges:
        out[a : b + 1] = True
    return out


# Bytes of words.  Fixed by the operators' contracts: all but white space, and
# digits, letters and everything beyond ASCII.
NOT_SPACE = ~byte_set((0x20, 0x20), (0x09, 0x0D))
ALNUM = byte_set((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def text_blocks(column: pa.Array, most_bytes: int = 1 << 19) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, data, offs) of runs of texts of about ``most_bytes``; null: empty.

    A longer text is a block of its own: texts are never cut.
    """
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    n = len(column)
    offs = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + n + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, dtype=np.uint8)
    i = 0
    while i < n:
        j = int(np.searchsorted(offs, offs[i] + most_bytes, side="right")) - 1
        j = min(n, max(j, i + 1))
        yield i, data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
        i = j


def word_spans(data: np.ndarray, offs: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first): byte spans of the words and each text's first word index (n+1)."""
    if len(data) == 0:
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty, np.zeros(len(offs), dtype=np.int64)
    w = is_word[data]
    start = w.copy()
    start[1:] &= ~w[:-1]
    end = w.copy()
    end[:-1] &= ~w[1:]
    at = offs[(offs > 0) & (offs < len(data))]
    start[at] = w[at]
    end[at - 1] = w[at - 1]
    s = np.flatnonzero(start)
    return s, np.flatnonzero(end) + 1, np.searchsorted(s, offs)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return Rolling(BYTE_VALUES[data]).slices(start, end)


def sequence(word_hash: np.ndarray) -> Rolling:
    """Rolling hashes over words."""
    return Rolling(word_hash, _WORD_BASE)


def inside(first: np.ndarray, n: int, k: int) -> np.ndarray:
    """Which of the starts 0..n-k of k consecutive values lie within one text."""
    ok = np.ones(max(0, n - k + 1), dtype=bool)
    if k > 1 and len(ok):
        crossing = np.zeros(n + 1, dtype=np.int32)
        cut = first[1:-1]
        np.add.at(crossing, np.maximum(cut - k + 1, 0), 1)
        np.add.at(crossing, cut, -1)
        ok &= np.cumsum(crossing)[: len(ok)] <= 0
    return ok


def window_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w consecutive values."""
    if len(x) < w:
        return x[:0]
    out, have = x, 1
    while have * 2 <= w:
        out = np.minimum(out[: len(out) - have], out[have:])
        have *= 2
    if have < w:
        n = len(x) - w + 1
        out = np.minimum(out[:n], out[w - have : w - have + n])
    return out


def winnow(gram_hash: np.ndarray, w: int) -> np.ndarray:
    """Position of the least of every w consecutive gram hashes, the leftmost of equals.

    The 24 low bits hold the position, so that one minimum finds both; what a
    window selects depends on its content alone.
    """
    low = _U((1 << 24) - 1)
    at = np.arange(len(gram_hash), dtype=np.uint64)
    least = window_min((gram_hash & ~low) | (at & low), w)
    begin = np.arange(len(least), dtype=np.int64)
    return begin + (((least & low).astype(np.int64) - begin) & int(low))


def cover(start: np.ndarray, length: int, n: int) -> np.ndarray:
    """Which of n places are covered by slices of ``length`` from the given starts."""
    steps = np.zeros(n + 1, dtype=np.int32)
    np.add.at(steps, start, 1)
    np.add.at(steps, np.minimum(start + length, n), -1)
    return np.cumsum(steps)[:n] > 0


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the maximal runs of true values."""
    edge = np.diff(np.concatenate(([False], mask, [False])).astype(np.int8))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
