"""Words, n-grams and sets of whole texts, computed over Arrow buffers with numpy.

Texts are UTF-8 bytes; the word separators (space and bytes 9 to 13) are single bytes that
never occur inside another character, so byte positions are enough. Hashes are 64-bit
polynomials over randomly mapped bytes, taken from prefix sums, then mixed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_RNG = np.random.default_rng(20240607)
BYTE_CODES = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(int(BASE), -1, 2**64))
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
# Bytes of text handled at once: bounds the memory of a task. A longer text goes alone.
CHUNK_BYTES = 1 << 18
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n-1 of the base and of its inverse modulo 2**64."""
    if len(_powers[0]) < n:
        size = max(n, CHUNK_BYTES + 4096)
        for k, b in enumerate((BASE, _BASE_INVERSE)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            _powers[k] = np.multiply.accumulate(p)
    return _powers[0][:n], _powers[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts, and n + 1 offsets into them; a null text has no bytes."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if texts.buffers()[2] is None or not len(texts):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of about ``limit`` bytes: first row, end row, bytes, offsets."""
    data, offsets = flat(texts)
    row, n = 0, len(offsets) - 1
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        end = min(max(end, row + 1), n)
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def first_bytes(offsets: np.ndarray, n: int) -> np.ndarray:
    """True where a text begins."""
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    return first[:n]


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and the word offsets of each text (n + 1)."""
    inside = ~SPACE[data]
    first = first_bytes(offsets, len(data))
    start, stop = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1] | first[1:]
    stop[:-1] &= ~inside[1:] | first[1:]
    starts = np.flatnonzero(start)
    return starts, np.flatnonzero(stop) + 1, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span."""
    power, inverse = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_CODES[data] * power[:-1], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def row_ids(word_offsets: np.ndarray) -> np.ndarray:
    """The text of each word."""
    return np.repeat(np.arange(len(word_offsets) - 1), np.diff(word_offsets))


def grams(hashes: np.ndarray, word_offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of n successive words within a text, and the first word of each."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    out = hashes[: len(hashes) - n + 1].copy()
    for k in range(1, n):
        out = out * BASE + hashes[k : len(hashes) - n + 1 + k]
    rows = row_ids(word_offsets)
    at = np.flatnonzero(rows[: len(rows) - n + 1] == rows[n - 1 :])
    return mix(out[at]), at


def row_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs; an empty run sums to zero."""
    total = np.zeros((len(values) + 1, *values.shape[1:]), np.result_type(values.dtype, np.int64))
    np.cumsum(values, axis=0, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]
