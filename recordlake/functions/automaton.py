"""Many words searched in texts at once: an Aho-Corasick automaton in flat numpy arrays.

The trie of the words has one number per node; steps are (node, byte) pairs in one table, and
arrays hold per node the failure link, the word that ends there and the next shorter word that
ends there too. Texts are read as the UTF-8 bytes of an Arrow buffer. They are cut into lanes
that overlap by the longest word, and all lanes take a step at a time, so the work per byte
does not depend on how many words there are.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from recordlake.functions.lookup import Table

LANE = 1024
# Bytes of text that are searched together; a longer text comes alone.
CHUNK_BYTES = 1 << 21


class Automaton:
    """Words are distinct and not empty; they may overlap, contain each other, be any text."""

    def __init__(self, words: Sequence[str]):
        self.words = pa.array(words, pa.string())
        raw = [w.encode("utf-8") for w in words]
        self.sizes = np.array([len(r) for r in raw], np.int64)
        self.longest = int(self.sizes.max(initial=1))
        data = np.frombuffer(b"".join(raw), np.uint8).astype(np.int64)
        starts = np.concatenate([[0], np.cumsum(self.sizes)])[:-1].astype(np.int64)
        # Level by level: the nodes of one more byte.
        node, active, n_nodes, depth = np.zeros(len(raw), np.int64), np.arange(len(raw)), 1, 0
        levels, ends = [], [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        while len(active):
            step, own = np.unique(node[active] << 8 | data[starts[active] + depth], return_inverse=True)
            levels.append((step, n_nodes + np.arange(len(step))))
            node[active] = n_nodes + own
            n_nodes += len(step)
            depth += 1
            over = self.sizes[active] == depth
            ends.append((node[active[over]], active[over]))
            active = active[~over]
        none = np.zeros(0, np.int64)
        self.steps = Table(np.concatenate([none, *(s for s, _ in levels)]), np.concatenate([none, *(t for _, t in levels)]))
        self.root = np.maximum(self.steps.get(np.arange(256), 0), 0)
        self.word = np.full(n_nodes, -1, np.int64)
        for at, which in ends:
            self.word[at] = which
        self.fail = np.zeros(n_nodes, np.int64)
        self.shorter = np.zeros(n_nodes, np.int64)
        for step, to in levels[1:]:
            # The level above is complete, so its links lead to complete nodes.
            link = self.move(self.fail[step >> 8], step & 255)
            self.fail[to] = link
            self.shorter[to] = np.where(self.word[link] >= 0, link, self.shorter[link])
        self.tells = (self.word >= 0) | (self.shorter > 0)

    def move(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """Where each node goes with a byte, over failure links where it has no such step."""
        out = self.root[byte]
        own, at = np.flatnonzero(node), node[node > 0]
        while len(own):
            to = self.steps.get(at << 8 | byte[own], -1)
            out[own[to >= 0]] = to[to >= 0]
            own, at = own[to < 0], self.fail[at[to < 0]]
            own, at = own[at > 0], at[at > 0]
        return out

    def _hits(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, node and end of every place where a word ends; overlaps of lanes repeat some."""
        size = max(LANE, 4 * self.longest)
        lengths = np.diff(offsets)
        lanes = -(-lengths // size)
        text = np.repeat(np.arange(len(lengths)), lanes)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        start = offsets[text] + nth * size
        stop = np.minimum(start + size + self.longest - 1, offsets[text + 1])
        order = np.argsort(start - stop, kind="stable")  # the longest first
        text, start, span = text[order], start[order], (stop - start)[order]
        node = np.zeros(len(text), np.int64)
        found = [(node[:0], node[:0], node[:0])]
        for step in range(int(span.max(initial=0))):
            n = int(np.searchsorted(-span, -step, "left"))
            node[:n] = self.move(node[:n], data[start[:n] + step].astype(np.int64))
            told = np.flatnonzero(self.tells[node[:n]])
            if len(told):
                found.append((text[told], node[told], start[told] + step + 1))
        return tuple(map(np.concatenate, zip(*found)))

    def first_places(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, word and first byte of the first place of every word in every text."""
        text, node, end = self._hits(data, offsets)
        text, node, end = _earliest(text, node, end)
        texts, words, starts = [], [], []
        while len(text):
            word = self.word[node]
            own = word >= 0
            texts.append(text[own])
            words.append(word[own])
            starts.append(end[own] - self.sizes[word[own]])
            node = self.shorter[node]
            text, node, end = text[node > 0], node[node > 0], end[node > 0]
        if not texts:
            return text, node, end
        return _earliest(*map(np.concatenate, (texts, words, starts)))

    def search(self, texts: pa.Array) -> pa.Array:
        """Per text a list of (word, at): each word found, by first place, counted in characters."""
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        blank = pc.fill_null(texts.cast(pa.large_string()), "")
        sizes = np.concatenate([[0], np.cumsum(pc.binary_length(blank).to_numpy(zero_copy_only=False))])
        parts, row = [], 0
        while row < len(blank):
            end = int(np.searchsorted(sizes, sizes[row] + CHUNK_BYTES, "right")) - 1
            end = min(max(end, row + 1), len(blank))
            parts.append(self._search(blank.slice(row, end - row)))
            row = end
        return pa.concat_arrays(parts) if parts else pa.array([], HITS)

    def _search(self, texts: pa.Array) -> pa.Array:
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        body = texts.buffers()[2]
        data = np.frombuffer(body, np.uint8)[offsets[0] : offsets[-1]] if body is not None else np.zeros(0, np.uint8)
        offsets = offsets - offsets[0]
        text, word, start = self.first_places(data, offsets)
        order = np.lexsort((word, start, text))
        text, word, start = text[order], word[order], start[order]
        heads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        at = heads[start] - heads[offsets[text]]
        cuts = np.searchsorted(text, np.arange(len(texts) + 1)).astype(np.int32)
        hits = pa.StructArray.from_arrays([self.words.take(pa.array(word)), pa.array(at.astype(np.int32))], ["word", "at"])
        return pa.ListArray.from_arrays(pa.array(cuts), hits)


HITS = pa.list_(pa.struct([("word", pa.string()), ("at", pa.int32())]))


def _earliest(text, what, place):
    """The smallest place of each (text, what)."""
    order = np.lexsort((place, what, text))
    text, what, place = text[order], what[order], place[order]
    new = np.ones(len(text), bool)
    new[1:] = (np.diff(text) != 0) | (np.diff(what) != 0)
    return text[new], what[new], place[new]
