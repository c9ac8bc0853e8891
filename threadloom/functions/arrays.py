"""Counts and lookups of numbers in arrays, for tasks that see a number per word or gram."""

import numpy as np

#: Different numbers that a task counts before it passes them on.
HELD = 1 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)
#: Stands for no number; numbers are below it.
_NONE = np.uint64(2**64 - 1)


class Counts:
    """Counts of numbers, in sorted arrays that are merged when they hold too many."""

    def __init__(self):
        self.parts, self.held = [], 0

    def add(self, keys: np.ndarray, counts: np.ndarray | None = None) -> None:
        if counts is None:
            keys, counts = np.unique(keys, return_counts=True)
        self.parts.append((keys, counts))
        self.held += len(keys)
        if self.held > 2 * HELD and len(self.parts) > 1:
            self.merged()

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        if len(self.parts) > 1:
            keys, counts = (np.concatenate(c) for c in zip(*self.parts, strict=True))
            order = np.argsort(keys, kind="stable")
            keys, counts = keys[order], counts[order]
            new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            self.parts = [(keys[new], np.add.reduceat(counts, new))]
        keys, counts = self.parts[0] if self.parts else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        self.held = len(keys)
        return keys, counts


class Places:
    """A hash table from numbers to their places in an array; a number that is not there has the place after the last."""

    def __init__(self, keys: np.ndarray):
        bits = max(4, (2 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), np.int64((1 << bits) - 1)
        self.held, self.place = np.full(1 << bits, _NONE), np.full(1 << bits, len(keys), np.int32)
        left, slot = np.arange(len(keys), dtype=np.int32), self._slot(keys)
        while len(left):
            free = self.held[slot] == _NONE
            self.held[slot[free]] = keys[left[free]]  # of several one stays
            own = self.held[slot] == keys[left]
            self.place[slot[own]] = left[own]
            left, slot = left[~own], (slot[~own] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _ODD) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slot(keys)
        held, out = self.held[slot], self.place[slot]
        left = np.flatnonzero((held != keys) & (held != _NONE))
        while len(left):
            slot[left] = (slot[left] + 1) & self.mask
            held = self.held[slot[left]]
            out[left] = self.place[slot[left]]
            left = left[(held != keys[left]) & (held != _NONE)]
        return out
