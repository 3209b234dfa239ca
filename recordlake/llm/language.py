"""Language identification with error-correcting output codes.

Every language has a codeword of bits. One binary classifier per bit, over hashed byte
n-grams of the lower-cased text, predicts on which side of the bit the text's language is
(naive Bayes log-odds, averaged over the n-grams). Decoding weighs the logistic loss of each
bit by how reliable its classifier was in training and takes the codeword with the smallest
loss; a small distance to the runner-up marks the answer as ambiguous.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlake.llm import bytesets as bs
from recordlake.llm.bpe import _type
from recordlake.llm.store import held_out, small, stored

ORDERS = (2, 4)
BITS = 15
# About this many texts of each language are learned from.
ROWS_PER_LANGUAGE = 1500
# Features are dealt out in slices, so nothing holds a whole language model but the result.
SLICE = 256
# Groups of texts that each language's counts are taken in, and n-grams looked up at once.
SHARES = 4
LOOKUPS = 1 << 15
SHARPNESS = 4.0
AMBIGUOUS = 0.15
UNKNOWN = "und"


@dataclass
class Model:
    languages: list[str]
    codes: np.ndarray  # languages x bits, +1 or -1
    weights: np.ndarray  # n-grams x bits
    trust: np.ndarray  # bits, sums to 1


def codewords(n: int) -> np.ndarray:
    """One row of +1 / -1 per language, far apart from each other.

    Few languages get all splits into two sides; more get the best of some random codes.
    """
    if n < 2:
        return np.ones((n, 1))
    if n <= 5:
        sides = [s for s in product((1, -1), repeat=n) if s[0] == 1 and -1 in s]
        return np.array(sides, float).T
    bits = int(np.ceil(10 * np.log2(n)))
    best, apart = None, -1
    for seed in range(30):
        code = np.random.default_rng(seed).choice([-1.0, 1.0], (n, bits))
        if (np.abs(code.sum(0)) == n).any():
            continue
        most = -bits
        for s in range(0, n, 1000):
            agree = code[s : s + 1000] @ code.T
            agree[np.arange(len(agree)), np.arange(s, s + len(agree))] = -bits
            most = max(most, agree.max())
        if bits - most > apart:
            best, apart = code, bits - most
    return best


def ngrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of all n-grams inside the texts, and the text offsets of each family."""
    codes = bs.BYTE_CODES[data]
    first = bs.first_bytes(offsets, len(data))
    index, cuts = [], []
    for k, order in enumerate(ORDERS):
        if len(data) < order:
            index.append(np.zeros(0, np.int64))
            cuts.append(np.zeros(len(offsets), np.int64))
            continue
        n = len(data) - order + 1
        h, whole = codes[:n].copy(), np.ones(n, bool)
        for i in range(1, order):
            h = h * bs.BASE + codes[i : n + i]
            whole &= ~first[i : n + i]
        at = np.flatnonzero(whole)
        index.append((bs.mix(h[at]) >> np.uint64(64 - BITS)).astype(np.int64) + (k << BITS))
        cuts.append(np.searchsorted(at, offsets))
    return index, cuts


def counts(texts: pa.Array) -> np.ndarray:
    """How often each feature occurs in the texts, long ones counted like 2,000 n-grams."""
    total = np.zeros(len(ORDERS) << BITS)
    for _, _, data, offsets in bs.chunks(_folded(texts)):
        for index, cuts in zip(*ngrams(data, offsets)):
            size = np.diff(cuts)
            weight = np.minimum(1.0, 2000 / np.maximum(size, 1))
            total += np.bincount(index, np.repeat(weight, size), len(total))
    return total


def _folded(texts):
    return pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))


def margins(data: np.ndarray, offsets: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Texts x bits: mean log-odds over the n-grams, a bounded number of them at a time."""
    total = np.zeros((len(offsets) - 1, weights.shape[1]))
    seen = np.zeros(len(offsets) - 1)
    for index, cuts in zip(*ngrams(data, offsets)):
        seen += np.diff(cuts)
        for start in range(0, len(index), LOOKUPS):
            part = index[start : start + LOOKUPS]
            within = np.clip(cuts - start, 0, len(part))
            full = np.flatnonzero(np.diff(within))
            total[full] += np.add.reduceat(weights[part], within[full], axis=0)
    return total / np.maximum(seen, 1)[:, None]


def fit(docs: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE) -> Model:
    """Learn from text and lang of rows that are not held out.

    Rows with a null lang, text or id take no part. Each language is sampled by a hash of the
    id and text with the share that gives about ``rows_per_language`` texts; every language is
    learned. Counts stay in slices of the features: a slice's counts of all languages become
    the weights of its features in one small group. The driver gets the languages, the
    finished weights and a row of bits per language.
    """
    usable = docs.where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()
    )
    sizes = usable.groupBy(F.col("lang").alias("_lang")).agg(
        F.least(F.lit(1.0), F.lit(float(rows_per_language)) / F.count("*")).alias("_share")
    )
    place = F.pmod(F.xxhash64("doc_id", "text", F.lit(3)), F.lit(1_000_000)) / F.lit(1_000_000.0)
    sample = usable.select("lang", "text", place.alias("_place")).join(small(sizes), F.col("lang") == F.col("_lang")).where(
        F.col("_place") < F.col("_share")
    ).select("lang", "text", F.pmod(F.xxhash64("text"), F.lit(SHARES)).alias("_part"))
    n_slices = (len(ORDERS) << BITS) // SLICE

    def count(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, lang = np.zeros(len(ORDERS) << BITS), None
        for batch in batches:
            total += counts(batch["text"])
        lang = pa.array([key[0].as_py()] * n_slices, pa.string())
        found = [x.tobytes() for x in total.astype(np.float32).reshape(n_slices, SLICE)]
        yield pa.RecordBatch.from_arrays([lang, pa.array(np.arange(n_slices)), pa.array(found, pa.binary())], ["lang", "slice", "counts"])

    # Rows of fixed size: a slice of the features, per language and group of its texts.
    found = stored(
        sample.groupBy("lang", "_part").applyInArrow(count, "lang string, slice long, counts binary"), "language-counts"
    )

    def n_grams(batches):
        for batch in batches:
            n = [np.frombuffer(c, np.float32).sum(dtype=float) for c in batch["counts"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["lang"], pa.array(n, pa.float64())], ["lang", "n"])

    totals = found.select("lang", "counts").mapInArrow(n_grams, "lang string, n double").groupBy("lang").agg(F.sum("n").alias("n")).collect()
    n_of = {r["lang"]: max(r["n"], 1.0) for r in totals}
    languages = sorted(n_of)
    if not languages:
        return Model([], np.ones((0, 1)), np.zeros((len(ORDERS) << BITS, 1)), np.ones(1))
    codes = codewords(len(languages))
    row_of = {lang: i for i, lang in enumerate(languages)}
    sent = docs.sparkSession.sparkContext.broadcast((codes, row_of, n_of))

    def weigh(key, table):
        codes, row_of, n_of = sent.value
        share = np.zeros((len(codes), SLICE))
        for lang, own in zip(table["lang"].to_pylist(), table["counts"].to_pylist()):
            share[row_of[lang]] += np.frombuffer(own, np.float32) / n_of[lang]
        plus = codes > 0
        n_plus = plus.sum(0)
        weights = np.zeros((SLICE, codes.shape[1]), np.float32)
        if len(codes) > 1:
            on = share.T @ plus / n_plus
            off = share.T @ ~plus / (len(codes) - n_plus)
            weights = np.log((on + 1e-6) / (off + 1e-6)).astype(np.float32)
        return pa.table({"slice": pa.array([key[0].as_py()], pa.int64()), "weights": pa.array([weights.tobytes()], pa.binary())})

    weights = np.zeros((len(ORDERS) << BITS, codes.shape[1]), np.float32)
    for r in found.groupBy("slice").applyInArrow(weigh, "slice long, weights binary").collect():
        weights[r["slice"] * SLICE : (r["slice"] + 1) * SLICE] = np.frombuffer(r["weights"], np.float32).reshape(SLICE, -1)
    # Reliability: how far apart the sides' mean margins are, over the languages of the bit.
    model = docs.sparkSession.sparkContext.broadcast(weights)

    def own_margin(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, row_of, n_of = sent.value
        lang, total = key[0].as_py(), np.zeros(codes.shape[1])
        for batch in batches:
            for slice_, own in zip(batch["slice"].to_pylist(), batch["counts"].to_pylist()):
                total += np.frombuffer(own, np.float32) / n_of[lang] @ model.value[slice_ * SLICE : (slice_ + 1) * SLICE]
        yield pa.RecordBatch.from_arrays([pa.array([(total * codes[row_of[lang]]).tolist()], pa.list_(pa.float64()))], ["margin"])

    margin = np.array([r["margin"] for r in found.groupBy("lang").applyInArrow(own_margin, "margin array<double>").collect()])
    trust = np.maximum(margin.min(0), 1e-3)
    return Model(languages, codes, weights, trust / trust.sum())


def decode(margin: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest codeword, its score and the distance to the next one, per text."""
    plus, minus = (np.logaddexp(0, -SHARPNESS * side * margin) * model.trust for side in (1, -1))
    loss = plus @ (model.codes > 0).T + minus @ (model.codes < 0).T
    close = np.exp(-(loss - loss.min(1, keepdims=True)))
    best = loss.argmin(1)
    score = close.max(1) / close.sum(1)
    ordered = np.sort(loss, 1)
    gap = ordered[:, 1] - ordered[:, 0] if loss.shape[1] > 1 else np.full(len(loss), np.inf)
    return best, score, gap


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, ambiguous) for every row, from its text alone.

    ``und`` with score 0 for a null text, a text without a letter, or an empty model.
    Repeated rows give repeated results; other columns are not read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def apply(batches):
        m = sent.value
        for batch in batches:
            folded = _folded(batch.column(1))
            for row, end, data, offsets in bs.chunks(folded):
                n = end - row
                letters = pc.match_substring_regex(folded.slice(row, n), r"\p{L}").to_numpy(zero_copy_only=False)
                if m.languages:
                    best, score, gap = decode(margins(data, offsets, m.weights), m)
                    names = np.where(letters, np.array(m.languages, object)[best], UNKNOWN)
                    score, unsure = np.where(letters, score, 0.0), ~letters | (gap < AMBIGUOUS)
                else:
                    names, score, unsure = np.full(n, UNKNOWN, object), np.zeros(n), np.ones(n, bool)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, n), pa.array(names, pa.string()), pa.array(score), pa.array(unsure)],
                    ["doc_id", "lang_pred", "score", "ambiguous"],
                )

    out = docs.select("doc_id", "text").mapInArrow(
        apply, f"doc_id {_type(docs)}, lang_pred string, score double, ambiguous boolean"
    )
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "ambiguous")
