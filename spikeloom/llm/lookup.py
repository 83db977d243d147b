"""Compact tables searched by many keys at once inside Arrow tasks: open addressing over numpy arrays."""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])


class HashTable:
    """Row numbers by 64-bit hash, at most half full. Of equal hashes one is kept: what else a
    row holds must be compared by the caller."""

    def __init__(self, hashes: np.ndarray):
        bits = max(4, int(2 * len(hashes)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.rows = np.full(1 << bits, -1, np.int32)
        self.hashes = np.zeros(1 << bits, np.uint64)
        wait = np.unique(hashes, return_index=True)[1]
        at = (hashes[wait] >> self.shift).astype(np.int64)
        while len(wait):
            free = self.rows[at] < 0
            self.rows[at[free]] = wait[free]
            left = self.rows[at] != wait
            wait, at = wait[left], (at[left] + 1) & self.mask
        held = self.rows >= 0
        self.hashes[held] = hashes[self.rows[held]]

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The row of each hash, -1 where there is none."""
        at = (hashes >> self.shift).astype(np.int64)
        out = self.rows[at]
        wait = np.flatnonzero((out >= 0) & (self.hashes[at] != hashes))
        at = at[wait]
        while len(wait):
            at = (at + 1) & self.mask
            out[wait] = self.rows[at]
            on = (out[wait] >= 0) & (self.hashes[at] != hashes[wait])
            wait, at = wait[on], at[on]
        return out
