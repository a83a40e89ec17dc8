"""A hash table of numbers for look-ups of many keys at once."""

from __future__ import annotations

import numpy as np


class Table:
    """Numbers under 63-bit keys, looked up for many keys at once; -1 for unknown keys."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, (2 * len(keys)).bit_length())
        self.mask, self.shift = (1 << bits) - 1, np.uint64(64 - bits)
        self.keys = np.full(1 << bits, -1, np.int64)
        self.values = np.full(1 << bits, -1, np.int64)
        at = self._home(keys)
        while len(keys):
            free = self.keys[at] == -1
            self.keys[at[free]] = keys[free]  # of keys that meet here the last stays
            here = self.keys[at] == keys
            self.values[at[here]] = values[here]
            keys, values, at = keys[~here], values[~here], at[~here] + 1 & self.mask

    @classmethod
    def of(cls, entries: dict[int, int]) -> Table:
        n = len(entries)
        return cls(np.fromiter(entries.keys(), np.int64, n), np.fromiter(entries.values(), np.int64, n))

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        at = self._home(keys)
        held = self.keys[at]
        out = np.where(held == keys, self.values[at], -1)
        left = np.flatnonzero((held != keys) & (held != -1))
        at = at[left]
        while len(left):
            at = at + 1 & self.mask
            held = self.keys[at]
            hit = held == keys[left]
            out[left[hit]] = self.values[at[hit]]
            on = ~hit & (held != -1)
            left, at = left[on], at[on]
        return out
