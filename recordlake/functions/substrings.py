"""Places in texts where one of very many words may stand, told by a filter of fixed size.

Words are known by their length in bytes and a hash. A bitmap has a bit for the hash of every
word, and one for the hash of its first bytes, as many as the largest power of two that is not
longer. Sums over all bytes of a text give the hash of any piece of it, so every place is asked
for each power of two, and only places that may begin a word for the lengths of words. What
passes is a candidate: the filter drops no word, but a join with the words has to follow.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from recordlake.functions.automaton import CHUNK_BYTES, HITS

BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
MIX = np.uint64(0xD6E8FEB86659FD93)
# Bits of a block of Spark's bitmap functions; the filter has 1 to 2,048 of them (8 MB).
BLOCK_BITS, MAX_BLOCKS = 1 << 15, 1 << 11


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _places(hashes: np.ndarray, size: int, bits: int) -> np.ndarray:
    """Bits for pieces of ``size`` bytes; ``bits`` is a power of two."""
    mixed = (hashes ^ (hashes >> np.uint64(31))) * MIX + np.uint64(size * int(BASE) % (1 << 64))
    mixed = (mixed ^ (mixed >> np.uint64(29))) * MIX
    return (mixed >> np.uint64(64 - (bits.bit_length() - 1))).astype(np.int64)


def head_size(size: int) -> int:
    return 1 << (size.bit_length() - 1)


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of texts without nulls."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    body = texts.buffers()[2]
    data = np.frombuffer(body, np.uint8)[offsets[0] : offsets[-1]] if body is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def word_bits(words: pa.Array, bits: int) -> pa.Array:
    """The bits of each word: of the whole and of its first bytes."""
    data, offsets = buffers(words.cast(pa.large_string()))
    sizes = np.diff(offsets)
    sums, inverse = _sums(data)
    out = np.zeros((len(sizes), 2), np.int64)
    for size in np.unique(sizes):
        own = np.flatnonzero(sizes == size)
        for k, n in enumerate((int(size), head_size(int(size)))):
            at = offsets[own]
            out[own, k] = _places((sums[at + n] - sums[at]) * inverse[at], n, bits)
    return pa.FixedSizeListArray.from_arrays(pa.array(out.ravel()), 2).cast(pa.list_(pa.int64()))


def _sums(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of (byte + 1) * BASE ** place before each place, and the inverse of each power."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(BASE, len(data))[:-1], out=sums[1:])
    return sums, _powers(INVERSE, len(data))


class Filter:
    """``bitmap`` has the bits of all words, ``sizes`` their distinct lengths in bytes."""

    def __init__(self, bitmap: np.ndarray, sizes: list[int]):
        self.bitmap, self.bits = bitmap, len(bitmap) * 8
        self.sizes = sorted(sizes)

    def _may(self, hashes: np.ndarray, size: int) -> np.ndarray:
        at = _places(hashes, size, self.bits)
        return (self.bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 != 0

    def _candidates(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First byte and size of every place that passes, within one text and whole characters."""
        sums, inverse = _sums(data)
        heads = (data & 0xC0) != 0x80
        ends = np.append(heads, True)
        begins = np.flatnonzero(heads)
        left = np.repeat(offsets[1:], np.diff(offsets))[begins] - begins
        found = [(begins[:0], begins[:0])]
        for head in sorted({head_size(n) for n in self.sizes}):
            own = begins[left >= head]
            own = own[self._may((sums[own + head] - sums[own]) * inverse[own], head)]
            room = offsets[np.searchsorted(offsets, own, "right")] - own
            for size in (n for n in self.sizes if head_size(n) == head):
                at = own[room >= size]
                at = at[ends[at + size]]
                if size > head:
                    at = at[self._may((sums[at + size] - sums[at]) * inverse[at], size)]
                found.append((at, np.full(len(at), size)))
        return tuple(map(np.concatenate, zip(*found)))

    def search(self, texts: pa.Array) -> pa.Array:
        """Per text a list of (word, at): each candidate's first place, counted in characters."""
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        blank = pc.fill_null(texts.cast(pa.large_string()), "")
        ends = np.concatenate([[0], np.cumsum(pc.binary_length(blank).to_numpy(zero_copy_only=False))])
        parts, row = [], 0
        while row < len(blank):
            end = int(np.searchsorted(ends, ends[row] + CHUNK_BYTES, "right")) - 1
            end = min(max(end, row + 1), len(blank))
            parts.append(self._search(blank.slice(row, end - row)))
            row = end
        return pa.concat_arrays(parts) if parts else pa.array([], HITS)

    def _search(self, texts: pa.Array) -> pa.Array:
        data, offsets = buffers(texts)
        at, size = self._candidates(data, offsets)
        order = np.argsort(at, kind="stable")
        at, size = at[order], size[order]
        body = data.tobytes()
        words = pa.array([body[a : a + n].decode("utf-8", "replace") for a, n in zip(at.tolist(), size.tolist())], pa.string())
        text = np.searchsorted(offsets, at, "right") - 1
        codes = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
        # In the order of places, so the first of equal ones is the first place.
        _, first = np.unique(text * max(len(words), 1) + codes, return_index=True)
        first = np.sort(first)
        at, text = at[first], text[first]
        chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        place = (chars[at] - chars[offsets[text]]).astype(np.int32)
        cuts = np.searchsorted(text, np.arange(len(texts) + 1)).astype(np.int32)
        hits = pa.StructArray.from_arrays([words.take(pa.array(first)), pa.array(place)], ["word", "at"])
        return pa.ListArray.from_arrays(pa.array(cuts), hits)
