"""Inside a worker: recent results in two generations, and texts a few at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


class Recent(dict):
    """Results by key: those in use move to the young generation, the old one is let go when
    the young one is full. Holds at most twice ``size`` and the keys of one call."""

    def __init__(self, size: int):
        super().__init__()
        self.size, self.old, self.once = size, {}, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            return self.once[key]
        self[key] = value
        return value

    def learn(self, keys: Iterable, compute: Callable[[list], list], keep: Callable[[object], bool]) -> None:
        """Compute what is not known of ``keys``, all in one call; ``keep`` decides what stays
        beyond the next call."""
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        new = [k for k in keys if k not in self and k not in self.old]
        self.once = {}
        for key, value in zip(new, compute(new) if new else []):
            (self if keep(key) else self.once)[key] = value


def few_at_a_time(texts: pa.Array, limit: int) -> Iterator[tuple[int, int, list[str]]]:
    """Runs of texts of about ``limit`` characters: first row, end row, texts; null is empty.
    A longer text comes alone."""
    sizes = pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False)
    total = np.concatenate([[0], np.cumsum(sizes.astype(np.int64))])
    start = 0
    while start < len(texts):
        end = int(np.searchsorted(total, total[start] + limit, "right")) - 1
        end = min(max(end, start + 1), len(texts))
        yield start, end, [t or "" for t in texts.slice(start, end - start).to_pylist()]
        start = end
