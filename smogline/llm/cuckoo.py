"""Cuckoo filters over 16-byte keys, filled and asked in numpy."""

from __future__ import annotations

import numpy as np

SLOTS = 4
MOVES = 500


class Cuckoo:
    """A set of keys that may err on the side of containing: 16-bit fingerprints in buckets of four.

    A key's fingerprint lives in one of two buckets, either computed from the other and the
    fingerprint, so that entries can be moved and removed without the key.
    """

    def __init__(self, slots: np.ndarray):
        self.slots = slots

    @classmethod
    def sized(cls, keys: int) -> Cuckoo:
        buckets = 4
        while buckets * SLOTS * 0.8 < keys:
            buckets *= 2
        return cls(np.zeros((buckets, SLOTS), dtype=np.uint16))

    @classmethod
    def built(cls, keys: np.ndarray) -> Cuckoo:
        size = len(keys)
        while True:
            made = cls.sized(size)
            if made.add(keys):
                return made
            size = max(16, 2 * size)

    @classmethod
    def load(cls, data: bytes) -> Cuckoo:
        return cls(np.frombuffer(data, dtype=np.uint16).reshape(-1, SLOTS).copy())

    def dump(self) -> bytes:
        return self.slots.tobytes()

    def _other(self, at: np.ndarray, prints: np.ndarray) -> np.ndarray:
        turn = prints.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)
        return (at ^ turn.astype(np.int64)) & (len(self.slots) - 1)

    def _place(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Fingerprint (never 0, which marks a free slot) and first bucket of each key, given as rows of 16 bytes."""
        words = np.ascontiguousarray(keys).view("<u8").reshape(-1, 2)
        prints = (words[:, 0] & np.uint64(0xFFFF)).astype(np.uint16)
        return np.where(prints == 0, 1, prints).astype(np.uint16), (words[:, 1] & np.uint64(len(self.slots) - 1)).astype(np.int64)

    def add(self, keys: np.ndarray) -> bool:
        """Insert different keys; False if the filter is too full, which leaves it unusable."""
        prints, at = self._place(keys)
        for move in range(MOVES):
            if not len(prints):
                return True
            order = np.argsort(at, kind="stable")
            prints, at, n = prints[order], at[order], np.arange(len(at))
            rank = n - np.maximum.accumulate(np.where(np.r_[True, at[1:] != at[:-1]], n, 0))
            free = self.slots[at] == 0
            room = free.sum(axis=1)
            fits = rank < room
            slot = np.argsort(~free, axis=1, kind="stable")[n, np.minimum(rank, SLOTS - 1)]
            self.slots[at[fits], slot[fits]] = prints[fits]
            if move:  # a full bucket's first newcomer takes the place of an entry, which goes on to its other bucket
                evict = rank == room
                victim = (prints.astype(np.int64) + move) % SLOTS
                out = self.slots[at[evict], victim[evict]].copy()
                self.slots[at[evict], victim[evict]] = prints[evict]
                prints[evict] = out
            prints, at = prints[~fits], at[~fits]
            at = self._other(at, prints)
        return False

    def contains(self, keys: np.ndarray) -> np.ndarray:
        prints, at = self._place(keys)
        own = prints[:, None]
        return ((self.slots[at] == own) | (self.slots[self._other(at, prints)] == own)).any(axis=1)

    def remove(self, keys: np.ndarray) -> None:
        """Take out keys that are in the filter."""
        prints, at = self._place(keys)
        for own, first, second in zip(prints, at, self._other(at, prints)):
            for bucket in (first, second):
                hit = np.flatnonzero(self.slots[bucket] == own)
                if len(hit):
                    self.slots[bucket, hit[0]] = 0
                    break
            else:
                raise KeyError("not in the filter")
