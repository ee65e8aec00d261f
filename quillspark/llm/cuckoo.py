"""Cuckoo filters in numpy: 16-bit fingerprints, four slots a bucket, one filter a shard.

A filter answers "maybe in" or "surely not in" and, unlike a Bloom filter, forgets a key again. Keys are
64-bit hashes. The shard comes from the lowest bits, the fingerprint from the highest, the bucket from
those between; the other bucket is the first xor a hash of the fingerprint.
"""

from __future__ import annotations

import numpy as np

from quillspark.llm.tokens import mix

SLOTS, KICKS = 4, 500
_U = np.uint64


def _places(keys: np.ndarray, buckets) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fingerprint (never 0), first and second bucket of each key; buckets is a power of two, or one for each key."""
    mask = (np.asarray(buckets) - 1).astype(_U)
    prints = (keys >> _U(48)) | _U(0)
    prints = np.where(prints == 0, _U(1), prints)
    one = (mix(keys) >> _U(8)) & mask
    return prints, one, one ^ (mix(prints) & mask)


class CuckooFilter:
    """One shard's filter."""

    def __init__(self, buckets: int):
        self.table = np.zeros((buckets, SLOTS), np.uint16)

    @classmethod
    def of(cls, keys: np.ndarray) -> CuckooFilter:
        """A filter of all these keys, as small as they fit into; its size follows their number."""
        buckets = 1 << max(2, int(np.ceil(np.log2(max(1, len(keys)) / (SLOTS * 0.85)))))
        while True:
            out = cls(buckets)
            if all(map(out.insert, keys)):
                return out
            buckets *= 2

    @classmethod
    def load(cls, data: bytes) -> CuckooFilter:
        out = cls(0)
        out.table = np.frombuffer(data, np.uint16).reshape(-1, SLOTS).copy()
        return out

    def dump(self) -> bytes:
        return self.table.tobytes()

    def _put(self, bucket: int, mark: int) -> bool:
        free = np.flatnonzero(self.table[bucket] == 0)
        if len(free):
            self.table[bucket, free[0]] = mark
        return bool(len(free))

    def insert(self, key: np.uint64) -> bool:
        """False if the filter is too full; the caller then builds a larger one from the exact table."""
        mark, one, two = (int(x[0]) for x in _places(np.array([key], _U), len(self.table)))
        if self._put(one, mark) or self._put(two, mark):
            return True
        at = two
        for k in range(KICKS):
            slot = (mark + k) % SLOTS
            mark, self.table[at, slot] = int(self.table[at, slot]), mark
            at ^= int((mix(np.array([mark], _U)) & _U(len(self.table) - 1))[0])
            if self._put(at, mark):
                return True
        return False

    def delete(self, key: np.uint64) -> bool:
        """Forget a key that was inserted."""
        mark, one, two = (int(x[0]) for x in _places(np.array([key], _U), len(self.table)))
        for at in (one, two):
            held = np.flatnonzero(self.table[at] == mark)
            if len(held):
                self.table[at, held[0]] = 0
                return True
        return False

    def maybe(self, keys: np.ndarray) -> np.ndarray:
        """False where a key is surely not held."""
        prints, one, two = _places(keys, len(self.table))
        marks = prints.astype(np.uint16)[:, None]
        return (self.table[one.astype(np.int64)] == marks).any(1) | (self.table[two.astype(np.int64)] == marks).any(1)
