"""A fixed table of 64-bit keys, looked up many at a time with numpy."""

from __future__ import annotations

import numpy as np

_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def slots(keys: np.ndarray, bits: int) -> np.ndarray:
    """A place for each key in a table of ``2**bits``."""
    h = keys.astype(np.uint64)
    h = (h ^ (h >> np.uint64(32))) * _SPREAD
    return (h >> np.uint64(64 - bits)).astype(np.int64)


class Table:
    """Distinct non-negative 64-bit keys to numbers, looked up many at a time."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(2 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.zeros(1 << self.bits, np.int64)
        at = slots(keys, self.bits)
        while len(keys):
            free = self.keys[at] < 0
            # Of several keys that want a free place the last one gets it.
            self.keys[at[free]], self.values[at[free]] = keys[free], values[free]
            left = self.keys[at] != keys
            keys, values, at = keys[left], values[left], (at[left] + 1) & (len(self.keys) - 1)

    def get(self, keys: np.ndarray, default: int) -> np.ndarray:
        out = np.full(len(keys), default, np.int64)
        own, at = np.arange(len(keys)), slots(keys, self.bits)
        while len(own):
            seen, wanted = self.keys[at], keys[own]
            same = seen == wanted
            out[own[same]] = self.values[at[same]]
            on = ~same & (seen >= 0)
            own, at = own[on], (at[on] + 1) & (len(self.keys) - 1)
        return out
