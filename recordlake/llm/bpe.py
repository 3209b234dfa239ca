"""Byte-level BPE encoding and decoding by prefix dynamic programming.

For every prefix of a piece there is exactly one token with which its encoding can end. It
is the longest vocabulary entry ``t`` that ends the prefix, such that the last token of the
prefix before ``t`` and ``t`` itself stay apart when the merges run over both. These last
tokens are stored per prefix, so text can be appended without work on what came before, and
an edit needs new entries from its own position on only. Following the last tokens backwards
gives the encoding. Pieces are the matches of the split pattern; they repeat a lot, so a
worker keeps encoded pieces in tables of bounded size. Pieces it does not know are collected
for many texts and done together: one prefix length after the other, for all pieces at once.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame

from recordlake.functions.lookup import Table, slots
from recordlake.llm.tables import Recent, few_at_a_time

# White space as in the tokenizer's own matcher: the Unicode property.
PATTERN = public_tokenizers.PATTERN.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")
# Pieces of each of the two generations that are kept, and bytes of the longest of them.
CACHED_PIECES = 200_000
CACHED_BYTES = 128
# Longer pieces are encoded on their own; verdicts on pairs that are kept, as a power of two.
TOGETHER_BYTES = 512
PAIR_BITS = 18
KNOWN_PAIRS = 100_000
# Characters of text that are worked on together.
CHUNK_CHARS = 1 << 20


class Vocabulary:
    """Ranks of a byte-level BPE, with what each token was merged from."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.ranks = ranks
        self.bytes = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes[rank] = token
        self.reach: dict[bytes, int] = {}
        for token in ranks:
            if len(token) > 1:
                self.reach[token[-2:]] = max(len(token), self.reach.get(token[-2:], 0))
        self.merged: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.apart: dict[int, bool] = {}
        # Cut every token where its last merge happened. Smaller ranks come first, so the
        # parts of a token are known when it is reached.
        for rank, token in enumerate(self.bytes):
            if len(token) > 1 and (two := self._last_merge(token, rank)):
                self.parts[rank] = two
                self.merged[two] = rank
        self.lengths = np.array([len(b) for b in self.bytes], np.int64)
        self.encoded = Recent(CACHED_PIECES)
        self.steps, self.ends = self._trie()
        keys = np.array(list(self.merged), np.int64).reshape(-1, 2)
        self.merges = Table(keys[:, 0] << 32 | keys[:, 1], np.array(list(self.merged.values()), np.int64))
        self.halves = np.full((len(self.bytes), 2), -1, np.int64)
        if self.parts:
            self.halves[list(self.parts)] = list(self.parts.values())
        self.pair_keys = np.full(1 << PAIR_BITS, -1, np.int64)
        self.pair_apart = np.zeros(1 << PAIR_BITS, bool)

    def _trie(self) -> tuple[Table, np.ndarray]:
        """Steps (node, byte) -> node from node 0, and the token that ends at each node."""
        steps, tokens = {}, [-1]
        for token, rank in self.ranks.items():
            node = 0
            for byte in token:
                node = steps.setdefault(node << 8 | byte, len(steps) + 1)
                if node == len(tokens):
                    tokens.append(-1)
            tokens[node] = rank
        return Table(np.array(list(steps), np.int64), np.array(list(steps.values()), np.int64)), np.array(tokens, np.int64)

    def _last_merge(self, token: bytes, rank: int) -> tuple[int, int] | None:
        pieces = [self.ranks[token[i : i + 1]] for i in range(len(token))]
        while len(pieces) > 2:
            found = [(self.merged.get(two, rank), i) for i, two in enumerate(zip(pieces, pieces[1:]))]
            best, i = min(found)
            if best >= rank:
                return None
            pieces[i : i + 2] = [best]
        return pieces[0], pieces[1]

    def stay_apart(self, left: int, right: int) -> bool:
        """Do the merges over both tokens' bytes leave exactly these two?

        Undo merges, latest first. Of the two parts that touch the border, each exists until
        the merge that made its successor; if they are a pair that merges before that, the
        border does not hold. Of equal ranks the leftmost pair merges first.
        """
        never = len(self.bytes)
        until_left = until_right = never
        while True:
            pair = self.merged.get((left, right), never)
            if pair < until_left and pair <= until_right and pair < never:
                return False
            a, b = self.parts.get(left), self.parts.get(right)
            if a is None and b is None:
                return True
            if b is None or (a is not None and left > right):
                until_left, left = left, a[1]
            else:
                until_right, right = right, b[0]

    def last_tokens(self, piece: bytes, known: list[int] | None = None) -> list[int]:
        """The last token of every prefix (1 .. n); ``known`` holds those of a shared prefix."""
        last = list(known or [])
        rank_of, reach, apart = self.ranks.get, self.reach, self.apart
        for end in range(len(last) + 1, len(piece) + 1):
            # No entry that ends in these two bytes is longer than this.
            longest = reach.get(piece[end - 2 : end], 1) if end > 1 else 1
            for start in range(end - longest if end > longest else 0, end):
                token = rank_of(piece[start:end])
                if token is None:
                    continue
                if start:
                    key = last[start - 1] << 32 | token
                    fits = apart.get(key)
                    if fits is None:
                        if len(apart) >= KNOWN_PAIRS:
                            apart.clear()
                        fits = apart[key] = self.stay_apart(last[start - 1], token)
                    if not fits:
                        continue
                last.append(token)
                break
        return last

    def follow(self, last: list[int]) -> list[int]:
        """Tokens of a piece from its last tokens."""
        tokens, end = [], len(last)
        while end:
            tokens.append(last[end - 1])
            end -= len(self.bytes[last[end - 1]])
        return tokens[::-1]

    def encode_piece(self, piece: bytes) -> list[int]:
        return self.follow(self.last_tokens(piece))

    def append(self, piece: bytes, last: list[int], more: bytes) -> list[int]:
        """Last tokens after appending bytes to a piece whose last tokens are known."""
        return self.last_tokens(piece + more, last)

    def edit(self, piece: bytes, last: list[int], new: bytes) -> list[int]:
        """Last tokens of ``new``, computed from its first difference to ``piece`` on."""
        same = next((i for i, (a, b) in enumerate(zip(piece, new)) if a != b), min(len(piece), len(new)))
        return self.last_tokens(new, last[:same])

    def apart_all(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """:meth:`stay_apart` of many pairs; recent verdicts are kept, each under its own key."""
        key = left << 32 | right
        slot = slots(key, PAIR_BITS)
        out = self.pair_apart[slot]
        new = np.flatnonzero(self.pair_keys[slot] != key)
        if len(new):
            found, back = np.unique(key[new], return_inverse=True)
            verdict = self._judge(found >> 32, found & 0xFFFFFFFF)
            out[new] = verdict[back]
            at = slots(found, PAIR_BITS)
            self.pair_keys[at], self.pair_apart[at] = found, verdict
            # Of pairs that share a place the last one written stays, with its own verdict.
            self.pair_apart[at] = verdict[np.searchsorted(found, self.pair_keys[at])]
        return out

    def _judge(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        never = len(self.bytes)
        out, own = np.ones(len(left), bool), np.arange(len(left))
        until_left = np.full(len(left), never)
        until_right = until_left.copy()
        while len(own):
            pair = self.merges.get(left << 32 | right, never)
            joined = (pair < until_left) & (pair <= until_right) & (pair < never)
            out[own[joined]] = False
            a, b = self.halves[left, 1], self.halves[right, 0]
            on = ~joined & ((a >= 0) | (b >= 0))
            undo = (b < 0) | ((a >= 0) & (left > right))
            until_left, left = np.where(undo, left, until_left), np.where(undo, a, left)
            until_right, right = np.where(undo, until_right, right), np.where(undo, right, b)
            own, left, right, until_left, until_right = (x[on] for x in (own, left, right, until_left, until_right))
        return out

    def matches(self, data: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First byte, last byte and token of every vocabulary entry in the pieces, which end
        at ``stops`` (per byte)."""
        start = np.arange(len(data))
        node = np.zeros(len(data), np.int64)
        firsts, lasts, tokens = [start[:0]], [start[:0]], [start[:0]]
        step = 0
        while len(start):
            node = self.steps.get(node << 8 | data[start + step], -1)
            start, node = start[node >= 0], node[node >= 0]
            token = self.ends[node]
            hit = token >= 0
            firsts.append(start[hit])
            lasts.append(start[hit] + step)
            tokens.append(token[hit])
            step += 1
            more = start + step < stops[start]
            start, node = start[more], node[more]
        return np.concatenate(firsts), np.concatenate(lasts), np.concatenate(tokens)

    def last_tokens_all(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The last token of every prefix of every piece, at the prefix's last byte.

        Goes from prefix length to prefix length; at each one all pieces try their longest
        entry first, those where it does not hold the next one, and so on.
        """
        sizes = np.diff(offsets)
        begin = np.repeat(offsets[:-1], sizes)
        first, end, token = self.matches(data, np.repeat(offsets[1:], sizes))
        order = np.lexsort((first, end, end - begin[end]))
        first, end, token = first[order], end[order], token[order]
        group = np.flatnonzero(np.diff(end, prepend=-1))  # where a new prefix begins
        levels = np.searchsorted((end - begin[end])[group], np.arange(sizes.max(initial=0) + 1))
        last = np.zeros(len(data), np.int64)
        for a, b in zip(levels[:-1], levels[1:]):
            open_ = group[a:b]
            while len(open_):
                s, t = first[open_], token[open_]
                inner = s > begin[end[open_]]
                fits = ~inner
                fits[inner] = self.apart_all(last[s[inner] - 1], t[inner])
                last[end[open_[fits]]] = t[fits]
                open_ = open_[~fits] + 1
        return last

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of every piece, as little-endian unsigned 32-bit integers."""
        together = [p for p in pieces if 0 < len(p) <= TOGETHER_BYTES]
        sizes = np.array([len(p) for p in together], np.int64)
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        last = self.last_tokens_all(np.frombuffer(b"".join(together), np.uint8).astype(np.int64), offsets)
        # Follow the last tokens backwards, one token of every piece at a time.
        own, at, found = np.arange(len(together)), offsets[1:], []
        while len(own):
            token = last[at - 1]
            found.append((own, token))
            at = at - self.lengths[token]
            more = at > offsets[own]
            own, at = own[more], at[more]
        counts = np.zeros(len(together), np.int64)
        for k, (own, _) in enumerate(found):
            counts[own] = k + 1
        stops = np.cumsum(counts)
        ids = np.zeros(int(counts.sum()), "<u4")
        for k, (own, token) in enumerate(found):
            ids[stops[own] - 1 - k] = token
        raw, cuts = ids.tobytes(), (4 * np.concatenate([[0], stops])).tolist()
        done = iter([raw[a:b] for a, b in zip(cuts, cuts[1:])])
        return [
            next(done) if 0 < len(p) <= TOGETHER_BYTES else np.array(self.encode_piece(p), "<u4").tobytes()
            for p in pieces
        ]

    def encode(self, text: str) -> np.ndarray:
        """Token ids of a whole text."""
        return np.frombuffer(self.encode_texts([text])[0], "<u4")

    def encode_texts(self, texts: list[str]) -> list[bytes]:
        """Ids of every text, as little-endian unsigned 32-bit integers."""
        pieces = [_split(t) for t in texts]
        self.encoded.learn(
            set().union(*pieces), lambda new: self.encode_pieces([p.encode("utf-8") for p in new]),
            lambda p: len(p) <= CACHED_BYTES,
        )
        return [b"".join(map(self.encoded.__getitem__, p)) for p in pieces]

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids.tolist()))


_split = regex.compile(PATTERN).findall


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """One vocabulary per worker process."""
    return Vocabulary(path)


def rank_file(name: str = "byte_bpe_50k.tiktoken") -> str:
    return public_tokenizers.path(name)


def encode_documents(docs: DataFrame, name: str = "byte_bpe_50k.tiktoken", decoded: bool = False) -> DataFrame:
    """(doc_id, ids binary): token ids of every whole text, little-endian unsigned 32-bit.

    With ``decoded`` also the bytes that these ids stand for, from the same worker and
    vocabulary. A null or empty text has no ids. Rows stay as they are: repeated ids give
    repeated rows, other columns are left out, an empty table gives an empty table. Works row
    by row without a shuffle, so a text is the largest thing a task holds.
    """

    def encode(batches):
        vocab = vocabulary(rank_file(name))
        for batch in batches:
            for start, end, texts in few_at_a_time(batch.column(1), CHUNK_CHARS):
                ids = vocab.encode_texts(texts)
                columns = [batch.column(0).slice(start, end - start), pa.array(ids, pa.binary())]
                if decoded:
                    columns.append(pa.array([vocab.decode(np.frombuffer(i, "<u4")) for i in ids], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "decoded"][: len(columns)])

    schema = f"doc_id {_type(docs)}, ids binary" + ", decoded binary" * decoded
    return docs.select("doc_id", "text").mapInArrow(encode, schema)


def decode_documents(encoded: DataFrame, name: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    """(doc_id, ids, decoded binary): the bytes that the ids stand for; null ids give none."""

    def decode(batches):
        vocab = vocabulary(rank_file(name))
        for batch in batches:
            for row in range(0, batch.num_rows, 500):
                part = batch.slice(row, 500)
                out = [vocab.decode(np.frombuffer(b or b"", "<u4")) for b in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.binary())], ["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(decode, f"doc_id {_type(encoded)}, ids binary, decoded binary")


def _type(df: DataFrame, name: str = "doc_id") -> str:
    return df.schema[name].dataType.simpleString()
