"""Words, lines and shingles of whole Arrow batches in numpy, without a Python object per word.

A batch of texts is one flat byte buffer. Word borders come from a byte class table, word hashes from a
polynomial prefix sum modulo 2**64 (a span's sum times the inverse power of its start, then mixed), so a
word has the same 64-bit hash wherever it stands and on whichever executor it is read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that one numpy step handles; a longer text is a step of its own, hashed piece by piece.
STEP = 1 << 20
PIECE = 1 << 20

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1


def _class(inside) -> np.ndarray:
    return np.array([inside(b) for b in range(256)], dtype=bool)


#: Words are runs of anything but blank, tab, line feed, vertical tab, form feed and carriage return.
PLAIN = _class(lambda b: b not in (0x20, 9, 10, 11, 12, 13))
#: Words are runs of ASCII letters, digits and every code point above 0x7F.
ALNUM = _class(lambda b: 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit words that spreads every bit (the finaliser of splitmix64)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_BASE, -1, 1 << 64)
    up, down = np.full(PIECE + 1, _BASE, _U), np.full(PIECE + 1, inverse, _U)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def spans(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each run values[start:end] of 64-bit values, the same wherever the run stands."""
    up, down = _powers()
    if len(values) >= len(up):
        base = np.full(len(values) + 1, _BASE, _U), np.full(len(values) + 1, pow(_BASE, -1, 1 << 64), _U)
        base[0][0] = base[1][0] = 1
        up, down = (np.multiply.accumulate(x) for x in base)
    total = np.zeros(len(values) + 1, _U)
    np.cumsum(values * up[: len(values)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(_U))


@lru_cache(maxsize=2)
def _values(fold: bool) -> np.ndarray:
    values = mix(np.arange(1, 257, dtype=_U) * _U(0xD6E8FEB86659FD93))
    if fold:
        values[65:91] = values[97:123]
    return values


class Batch:
    """Some texts as one byte buffer. Text i is buf[off[i]:off[i + 1]]; null texts are empty."""

    def __init__(self, buf: np.ndarray, off: np.ndarray):
        self.buf, self.off = buf, off

    @property
    def n(self) -> int:
        return len(self.off) - 1

    def words(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of all words in reading order, and for each text the index of its first word (n + 1 values)."""
        size = len(self.buf)
        if size == 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(self.n + 1, np.int64)
        word = inside[self.buf]
        before = np.empty(size, bool)
        before[0], before[1:] = False, word[:-1]
        before[self.off[self.off < size]] = False
        after = np.empty(size, bool)
        after[-1], after[:-1] = False, word[1:]
        after[self.off[self.off > 0] - 1] = False
        starts, ends = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
        return starts, ends, np.searchsorted(starts, self.off)

    def count(self, inside: np.ndarray) -> np.ndarray:
        """Bytes of a class in each text."""
        total = np.concatenate(([0], np.cumsum(inside[self.buf], dtype=np.int64)))
        return total[self.off[1:]] - total[self.off[:-1]]

    def hashes(self, starts: np.ndarray, ends: np.ndarray, fold: bool) -> np.ndarray:
        """A 64-bit hash of each word; fold takes A-Z as a-z."""
        out = np.empty(len(starts), _U)
        values, (up, down) = _values(fold), _powers()
        i = 0
        while i < len(starts):
            a = starts[i]
            j = int(np.searchsorted(ends, a + PIECE, side="right"))
            if j <= i:  # a word longer than a piece: its blocks' sums, each shifted by its place
                total = 0
                for k in range(int(a), int(ends[i]), PIECE):
                    v = values[self.buf[k : min(k + PIECE, int(ends[i]))]]
                    total += int((v * up[: len(v)]).sum(dtype=_U)) * pow(_BASE, k - int(a), 1 << 64)
                out[i] = _U(total % (1 << 64))
                i += 1
                continue
            v = values[self.buf[a : ends[j - 1]]]
            total = np.zeros(len(v) + 1, _U)
            np.cumsum(v * up[: len(v)], out=total[1:])
            s = starts[i:j] - a
            out[i:j] = (total[ends[i:j] - a] - total[s]) * down[s]
            i = j
        return mix(out ^ ((ends - starts).astype(_U) * _U(0xA24BAED4963EE407)))


def batches(column: pa.Array, step: int = STEP) -> Iterator[tuple[int, Batch]]:
    """A string column as Batches of about `step` bytes, each with the index of its first text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_binary())
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(off, off[i] + step, side="right")) - 1)
        yield i, Batch(buf[off[i] : off[j]], off[i : j + 1] - off[i])
        i = j


def owners(first: np.ndarray) -> np.ndarray:
    """For each word the index of its text."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def shingles(words: np.ndarray, first: np.ndarray, size: int, short: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `size` words inside one text, and the index of each run's first word.

    With short, a text of fewer words, but not none, is one shorter run.
    """
    n = len(words)
    counts = np.diff(first)
    if n >= size:
        total = np.zeros(n - size + 1, _U)
        for k in range(size):
            total = (total + words[k : n - size + 1 + k]) * _U(0x9FB21C651E98DF25)
        starts = np.flatnonzero((owners(first)[: n - size + 1] == owners(first)[size - 1 :]))
        total = mix(total[starts])
    else:
        total, starts = np.zeros(0, _U), np.zeros(0, np.int64)
    if short:
        extra, at = [], []
        for i in np.flatnonzero((counts > 0) & (counts < size)):
            t = np.zeros(1, _U)
            for w in words[first[i] : first[i + 1]]:
                t = (t + w) * _U(0x9FB21C651E98DF25)
            extra.append(mix(t + _U(int(counts[i])))[0])
            at.append(first[i])
        if extra:
            total, starts = np.concatenate((total, np.array(extra, _U))), np.concatenate((starts, np.array(at, np.int64)))
            order = np.argsort(starts, kind="stable")
            total, starts = total[order], starts[order]
    return total, starts


def signed(x: np.ndarray) -> np.ndarray:
    """64-bit hashes as Spark longs."""
    return x.view(np.int64)
