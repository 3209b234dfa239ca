"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

The text, a space in front of it and every space written as U+2581, is cut into words: a mark
and what follows up to the next one. No piece holds a mark behind another character, so no
merge crosses words. The symbols of all words that are not known yet lie in one flat numpy
array. A round finds the best pair of every word (segmented minimum of the ranks), merges its
occurrences from the left, all words at once, and closes the gaps; words in which no pair is
left leave the array. Occurrences are only merged together if none of them makes a pair that
is at least as good as they are, because such a pair would come before the next occurrence;
otherwise the leftmost one goes alone. Words repeat, so a worker keeps encoded words in
tables of bounded size.

Pieces of marks alone share the lowest score, so runs of lone marks are left for the end,
where equal scores merge the leftmost pair first. A character without a piece becomes the
byte pieces of its UTF-8 form.
"""

from __future__ import annotations

import heapq
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from recordlake.functions.lookup import Table
from recordlake.llm.bpe import _type
from recordlake.llm.tables import Recent, few_at_a_time

SPACE = "▁"
# Words of each of the two generations that are kept, and characters of the longest of them.
CACHED_WORDS = 200_000
CACHED_CHARS = 64
# Characters of text that are worked on together.
CHUNK_CHARS = 1 << 20
# After so many rounds a word is finished one merge at a time.
ROUNDS = 2000
NEVER = 1 << 40
# Texts on which the marks' rules are tried against the library when a model is read.
PROBES = ["", " ", "a", "  a  b ", SPACE, "\t\n x", "a\u0000b", "\U0010fffd", " " * 40 + "x" + " " * 19, "ﬁ é　"]


class Pieces:
    """Pieces of a model and what they merge from."""

    def __init__(self, path: str):
        library = sentencepiece.SentencePieceProcessor(model_file=path)
        n = library.get_piece_size()
        names = [library.id_to_piece(i) for i in range(n)]
        special = [library.is_control(i) or library.is_unknown(i) or library.is_byte(i) for i in range(n)]
        if any(library.is_unused(i) for i in range(n)):
            raise ValueError("models with unused pieces are not supported")
        self.end, self.unknown = library.eos_id(), library.unk_id()
        known = {p: i for i, p in enumerate(names) if not special[i]}
        self.bytes_of = [-1] * 256
        for i in range(n):
            if library.is_byte(i):
                self.bytes_of[int(names[i][1:-1], 16)] = i
        if -1 in self.bytes_of or any(SPACE in p.lstrip(SPACE) for p in known):
            raise ValueError("only models with byte pieces and without marks inside words are supported")
        scores = np.array([library.get_score(i) for i in range(n)])
        ranks = np.searchsorted(np.unique(-scores), -scores)
        # Marks alone: at most one piece per length, all of the same, lowest score.
        self.space = known[SPACE]
        runs = {len(p): i for p, i in known.items() if not p.strip(SPACE)}
        shared = {ranks[i] for n, i in runs.items() if n > 1}
        others = {ranks[i] for p, i in known.items() if p.strip(SPACE) and len(p) > 1}
        inner = any(p.startswith(SPACE * 2) and p.strip(SPACE) for p in known)
        if inner or (shared and (len(shared) > 1 or min(shared) <= max(others, default=0))):
            raise ValueError("only models in which runs of marks come last are supported")
        self._learn_runs(runs)
        # Characters are their piece; one without a piece is a number below zero.
        self.symbol = -1 - np.arange(0x110000)
        for p, i in known.items():
            if len(p) == 1:
                self.symbol[ord(p)] = i
        number = lambda p: known.get(p, -1 - ord(p) if len(p) == 1 else None)
        keys, made = [], []
        for p, i in known.items():
            for k in range(1, len(p)) if p.strip(SPACE) else ():
                left, right = number(p[:k]), number(p[k:])
                if left is not None and right is not None:
                    keys.append((left, right))
                    made.append(i)
        pairs = np.array(keys, np.int64).reshape(-1, 2)
        self.pairs = Table(self._key(pairs[:, 0], pairs[:, 1]), np.array(made, np.int64))
        # One more, for no pair at all.
        self.rank = np.append(ranks, NEVER)
        self.none = n
        self.texts = [b"" if special[i] else names[i].replace(SPACE, " ").encode("utf-8") for i in range(n)]
        for value, i in enumerate(self.bytes_of):
            self.texts[i] = bytes([value])
        self.texts[self.unknown] = " ⁇ ".encode("utf-8")
        self.is_byte = np.zeros(n, bool)
        self.is_byte[self.bytes_of] = True
        self.is_control = np.array([library.is_control(i) for i in range(n)])
        self.leading = np.array([not special[i] and names[i].startswith(SPACE) for i in range(n)])
        self.encoded = Recent(CACHED_WORDS)
        for text in PROBES:
            ids = library.encode(text, add_eos=True)
            if self.encode(text).tolist() != ids or self.decode(np.array(ids)) != library.decode(ids):
                raise ValueError("the model changes texts in a way that is not supported")

    @staticmethod
    def _key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return (left + 0x110000) << 24 | (right + 0x110000)

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that two symbols make, or the number for none."""
        return self.pairs.get(self._key(left, right), self.none)

    def merge_words(self, symbols: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols and offsets of the words after all merges."""
        n = len(offsets) - 1
        word = np.repeat(np.arange(n), np.diff(offsets))
        pair = self._pairs_of(symbols, word)
        finished: list[tuple[np.ndarray, np.ndarray]] = []
        rounds = 0
        while len(symbols):
            rank = self.rank[pair]
            starts = np.flatnonzero(np.diff(word, prepend=-1))
            best = np.minimum.reduceat(rank, starts)
            length = np.diff(np.append(starts, len(symbols)))
            rounds += 1
            if rounds > ROUNDS:
                finished.append(self._one_by_one(symbols, starts, length, word))
                break
            on = np.repeat(best < NEVER, length)
            if not on.all():
                finished.append((word[~on], symbols[~on]))
                symbols, word, pair, rank = symbols[on], word[on], pair[on], rank[on]
                best, length = best[best < NEVER], length[best < NEVER]
                if not len(symbols):
                    break
            at = self._leftmost(rank == np.repeat(best, length))
            at = self._apart(symbols, word, pair, at, np.repeat(best, length))
            # Merge, then close the gaps.
            symbols[at] = pair[at]
            stay = np.ones(len(symbols), bool)
            stay[at + 1] = False
            place = np.cumsum(stay) - 1
            symbols, word, pair = symbols[stay], word[stay], pair[stay]
            new = place[at]
            new = np.unique(np.concatenate([new, np.maximum(new - 1, 0)]))
            pair[new] = self._pairs_of(symbols, word, new)
        word = np.concatenate([w for w, _ in finished]) if finished else word
        symbols = np.concatenate([s for _, s in finished]) if finished else symbols
        symbols = symbols[np.argsort(word, kind="stable")]
        return symbols, np.concatenate([[0], np.cumsum(np.bincount(word, minlength=n))])

    def _pairs_of(self, symbols, word, at=None):
        """What each symbol (of ``at``) makes with the next one of its word."""
        at = np.arange(len(symbols)) if at is None else at
        out = np.full(len(at), self.none)
        inner = np.flatnonzero(at + 1 < len(symbols))
        inner = inner[word[at[inner]] == word[at[inner] + 1]]
        out[inner] = self.merged(symbols[at[inner]], symbols[at[inner] + 1])
        return out

    @staticmethod
    def _leftmost(wanted: np.ndarray) -> np.ndarray:
        """Places that do not overlap, taken from the left: every second one of a run."""
        at = np.flatnonzero(wanted)
        first = np.diff(at, prepend=-2) != 1
        return at[(at - at[first][np.cumsum(first) - 1]) % 2 == 0]

    def _apart(self, symbols, word, pair, at, best):
        """``at`` without all but the first of a word in which a merge makes a pair as good."""
        made, n = pair[at], len(symbols)
        right = np.flatnonzero(at + 2 < n)
        right = right[word[at[right] + 2] == word[at[right]]]
        ahead = np.full(len(at), self.none)
        ahead[right] = self.merged(made[right], symbols[at[right] + 2])
        left = np.flatnonzero(at > 0)
        left = left[word[at[left] - 1] == word[at[left]]]
        before = symbols[at - 1]
        touching = np.flatnonzero(np.diff(at, prepend=-9) == 2)
        touching = touching[word[at[touching]] == word[at[touching] - 2]]
        before[touching] = made[touching - 1]
        behind = np.full(len(at), self.none)
        behind[left] = self.merged(before[left], made[left])
        as_good = np.minimum(self.rank[ahead], self.rank[behind]) <= best[at]
        if not as_good.any():
            return at
        alone = np.isin(word[at], word[at[as_good]])
        return at[~alone | (np.diff(word[at], prepend=-1) != 0)]

    def _one_by_one(self, symbols, starts, length, word):
        """The same merges for words that would take very many rounds: best pair first, from a heap."""
        out, owner = [], []
        for start, size in zip(starts, length):
            own = symbols[start : start + size].tolist()
            after, before = [*range(1, size), -1], [-1, *range(size - 1)]
            heap = []

            def offer(i):
                j = after[i]
                if j >= 0:
                    piece = int(self.merged(np.array([own[i]]), np.array([own[j]]))[0])
                    if piece != self.none:
                        heapq.heappush(heap, (int(self.rank[piece]), i, own[i], own[j], piece))

            for i in range(size - 1):
                offer(i)
            while heap:
                _, i, a, b, piece = heapq.heappop(heap)
                j = after[i]
                if own[i] != a or j < 0 or own[j] != b:
                    continue
                own[i], own[j], after[i] = piece, None, after[j]
                if after[j] >= 0:
                    before[after[j]] = i
                if before[i] >= 0:
                    offer(before[i])
                offer(i)
            kept = [s for s in own if s is not None]
            out += kept
            owner += [word[start]] * len(kept)
        return np.array(owner, np.int64), np.array(out, np.int64)

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of words (without their mark), as little-endian 32-bit integers."""
        flat = np.frombuffer((SPACE + SPACE.join(words)).encode("utf-32-le"), "<u4") if words else np.zeros(0, np.int64)
        offsets = np.concatenate([[0], np.cumsum([len(w) + 1 for w in words])]).astype(np.int64)
        symbols, offsets = self.merge_words(self.symbol[flat], offsets)
        # Characters without a piece become bytes.
        lost = np.flatnonzero(symbols < 0)
        if len(lost):
            points = -1 - symbols[lost]
            sizes = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
            wide = np.ones(len(symbols), np.int64)
            wide[lost] = sizes
            moved = np.concatenate([[0], np.cumsum(wide)])
            raw = np.frombuffer("".join(map(chr, points)).encode("utf-8"), np.uint8)
            symbols = np.repeat(symbols, wide)
            symbols[symbols < 0] = np.array(self.bytes_of)[raw]
            offsets = moved[offsets]
        raw, cuts = symbols.astype("<i4").tobytes(), (4 * offsets).tolist()
        return [raw[a:b] for a, b in zip(cuts, cuts[1:])]

    def _learn_runs(self, runs: dict[int, int]) -> None:
        """How a run of lone marks ends up: equal scores merge the leftmost pair first. Longer
        runs begin with the longest piece over and over."""

        def parts(n):
            out, at = [1] * n, 0
            while at + 1 < len(out):
                if out[at] + out[at + 1] in runs:
                    out[at : at + 2] = [out[at] + out[at + 1]]
                    at = 0
                else:
                    at += 1
            return out

        self.longest = max(runs)
        if any(parts(n) != [self.longest, *parts(n - self.longest)] for n in range(self.longest, 3 * self.longest)):
            raise ValueError("the model's runs of marks are not supported")
        # The piece that begins at each place of what is left after the longest ones, or -1.
        self.rest = np.full((self.longest, self.longest), -1)
        for n in range(self.longest):
            at = 0
            for size in parts(n):
                self.rest[n, at] = runs[size]
                at += size
        self.whole = runs[self.longest]

    def _chop(self, ids: np.ndarray) -> np.ndarray:
        """Runs of lone marks as pieces of marks."""
        lone = ids == self.space
        if not (lone[1:] & lone[:-1]).any():
            return ids
        place = np.flatnonzero(lone)
        first = np.diff(place, prepend=-2) != 1
        run = np.cumsum(first) - 1
        size = np.bincount(run)[run]
        nth = place - place[first][run]
        rest = size % self.longest
        over = nth - (size - rest)
        piece = np.where(nth % self.longest == 0, self.whole, -1)
        piece[over >= 0] = self.rest[rest[over >= 0], over[over >= 0]]
        out = ids.copy()
        out[place] = piece
        return out[out >= 0]

    def encode_texts(self, texts: list[str]) -> list[np.ndarray]:
        """All ids of every text, the end id last."""
        words = [t.replace(SPACE, " ").split(" ") if t else [] for t in texts]
        self.encoded.learn(set().union(*words), self.encode_words, lambda w: len(w) <= CACHED_CHARS)
        end = np.array([self.end], "<i4")
        return [
            np.concatenate([self._chop(np.frombuffer(b"".join(map(self.encoded.__getitem__, w)), "<i4")), end])
            for w in words
        ]

    def encode(self, text: str) -> np.ndarray:
        return self.encode_texts([text])[0]

    def decode(self, ids: np.ndarray) -> str:
        """The text that ids stand for: marks as spaces, without the first one of the text.

        Bytes that do not make a character become U+FFFD, one each.
        """
        ids = ids[~self.is_control[ids]]
        raw = b"".join(map(self.texts.__getitem__, ids.tolist()))
        try:
            text = raw.decode("utf-8")
        except UnicodeDecodeError:
            text = self._decode_broken(ids)
        return text[1:] if len(ids) and self.leading[ids[0]] else text

    def _decode_broken(self, ids: np.ndarray) -> str:
        out, cuts = [], np.flatnonzero(np.diff(self.is_byte[ids])) + 1
        for run in np.split(ids, cuts):
            raw = b"".join(self.texts[i] for i in run)
            while raw:
                try:
                    out.append(raw.decode("utf-8"))
                    break
                except UnicodeDecodeError as e:
                    out.append(raw[: e.start].decode("utf-8") + "�")
                    raw = raw[e.start + 1 :]
        return "".join(out)


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    """One model per worker process."""
    return Pieces(path)


def model_file(name: str = "piece_bpe_32k.model") -> str:
    return public_tokenizers.path(name)


def encode_documents(docs: DataFrame, name: str = "piece_bpe_32k.model", decoded: bool = False) -> DataFrame:
    """(doc_id, ids array<int>): ids of every whole text, with the end id and no start id.

    With ``decoded`` also the text these ids stand for, from the same worker and model. A
    null or empty text has the end id alone. Rows stay as they are: repeated ids give
    repeated rows, other columns are left out, an empty table gives an empty table. Works row
    by row without a shuffle, so a text is the largest thing a task holds.
    """

    def encode(batches):
        model = pieces(model_file(name))
        for batch in batches:
            for start, end, texts in few_at_a_time(batch.column(1), CHUNK_CHARS):
                ids = model.encode_texts(texts)
                cuts = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
                columns = [
                    batch.column(0).slice(start, end - start),
                    pa.ListArray.from_arrays(pa.array(cuts), pa.array(np.concatenate(ids).astype(np.int32))),
                ]
                if decoded:
                    columns.append(pa.array([model.decode(i) for i in ids], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "decoded"][: len(columns)])

    schema = f"doc_id {_type(docs)}, ids array<int>" + ", decoded string" * decoded
    return docs.select("doc_id", "text").mapInArrow(encode, schema)


def decode_ids(encoded: DataFrame, name: str = "piece_bpe_32k.model") -> DataFrame:
    """(doc_id, ids, decoded): the text that stored ids stand for; null ids give an empty one."""

    def decode(batches):
        model = pieces(model_file(name))
        for batch in batches:
            texts = [model.decode(np.array(i or [], np.int64)) for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], ["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(decode, f"doc_id {_type(encoded)}, ids array<int>, decoded string")
