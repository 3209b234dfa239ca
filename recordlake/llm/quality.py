"""Quality classifier: hashed word n-gram logistic regression, trained with FTRL-proximal.

Features of a text: its words, its pairs of neighbouring words, and the shapes of its words
(runs of letters of one case become one sign, runs of digits another), each hashed to one of
``2**BITS`` weights. Every occurrence has the value 1 / sqrt(occurrences of that family), so
a score is a sparse dot product whose size does not depend on the length of the text.

Training follows the regularised leader example by example. A bounded sample of labelled
rows is dealt into shards of fixed size; each shard trains its own weights in its own task
and the weights are averaged. Scoring is a pass over all rows without a shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlake.llm import bytesets as bs
from recordlake.llm.bpe import _type
from recordlake.llm.store import bounded, held_out

BITS = 18
# At most this many labelled rows are learned from, in shards of at least SHARD_ROWS. Passes
# over fewer rows are repeated until about TRAINING_ROWS * MIN_PASSES examples were seen.
TRAINING_ROWS = 16_000
SHARD_ROWS = 2_000
MIN_PASSES, MAX_PASSES = 3, 30
ALPHA, BETA, L1, L2 = 0.4, 1.0, 0.02, 0.5
THRESHOLD = 0.7

_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[97:123] = 1
_CLASS[65:91] = 2
_CLASS[48:58] = 3
_CLASS[128:] = 1


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weight numbers, their values and their texts, for a chunk of texts."""
    starts, ends, word_offsets = bs.words(data, offsets)
    rows = bs.row_ids(word_offsets)
    hashes = bs.span_hashes(data, starts, ends)
    pairs, at = bs.grams(hashes, word_offsets, 2)
    # A word followed by itself is one feature, whatever the word.
    pairs[hashes[at] == hashes[np.minimum(at + 1, len(hashes) - 1)]] = 1
    families = [(hashes, rows), (pairs, rows[at]), (_shapes(data, starts, ends), rows)]
    index, value, owner = [], [], []
    n = len(offsets) - 1
    for salt, (h, row) in enumerate(families):
        h = bs.mix(h + bs.BYTE_CODES[salt])
        index.append((h >> np.uint64(64 - BITS)).astype(np.int64))
        value.append((1 / np.sqrt(np.maximum(np.bincount(row, minlength=n), 1)))[row])
        owner.append(row)
    return np.concatenate(index), np.concatenate(value), np.concatenate(owner)


def _shapes(data, starts, ends):
    """Hashes of word shapes: a sign per run of equal character classes."""
    kind = _CLASS[data]
    kept = np.ones(len(data), bool)
    kept[1:] = (kind[1:] != kind[:-1]) | (kind[1:] > 3)
    kept[starts] = True
    place = np.concatenate([[0], np.cumsum(kept)])
    power, inverse = bs.powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(np.where(kept, bs.BYTE_CODES[kind] * power[place[:-1]], np.uint64(0)), out=sums[1:])
    return (sums[ends] - sums[starts]) * inverse[place[starts]]


def train(texts: pa.Array, labels: np.ndarray, passes: int = MIN_PASSES) -> np.ndarray:
    """Weights (the bias last) after FTRL-proximal updates in the order given."""
    size = 1 << BITS
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    examples = []
    for row, end, data, offsets in bs.chunks(texts):
        index, value, owner = features(data, offsets)
        order = np.argsort(owner, kind="stable")
        cuts = np.searchsorted(owner[order], np.arange(end - row + 1))
        for i in range(end - row):
            own = order[cuts[i] : cuts[i + 1]]
            f, which = np.unique(index[own], return_inverse=True)
            x = np.bincount(which, value[own], len(f)) if len(f) else np.zeros(0)
            examples.append((np.append(f, size), np.append(x, 1.0)))
    for _ in range(passes):
        for (f, x), y in zip(examples, labels):
            w = _weights(z[f], n[f], f == size)
            p = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
            g = (p - y) * x
            grown = n[f] + g * g
            z[f] += g - (np.sqrt(grown) - np.sqrt(n[f])) / ALPHA * w
            n[f] = grown
    return _weights(z, n, np.arange(size + 1) == size)


def _weights(z, n, bias):
    """The leader's weights; the bias is not shrunk."""
    l1, l2 = np.where(bias, 0.0, L1), np.where(bias, 0.0, L2)
    return np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((BETA + np.sqrt(n)) / ALPHA + l2))


def fit(docs: DataFrame, labels: DataFrame, training_rows: int = TRAINING_ROWS) -> np.ndarray | None:
    """Weights learned from ``docs`` joined with ``labels`` (doc_id, quality).

    Rows whose crc32(doc_id) mod 4 is 2 are held out. Rows with a null id, label or text take
    no part; of conflicting labels the smaller counts. None if no labelled row is left.
    """
    known = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id").agg(F.min("quality").alias("_label"))
    )
    # The sample has a fixed bound (16,000 small rows), so it can be broadcast.
    sample = bounded(known, "doc_id", training_rows)
    size = sample.count()
    shards = max(1, size // SHARD_ROWS)
    passes = min(MAX_PASSES, max(MIN_PASSES, TRAINING_ROWS * MIN_PASSES // max(size, 1)))
    rows = (
        docs.where(F.col("text").isNotNull()).select("doc_id", "text")
        .join(F.broadcast(sample), "doc_id")
        .select(F.pmod(F.xxhash64("doc_id"), F.lit(shards)).alias("_shard"), "doc_id", "text", "_label")
    )

    def one(table):
        table = table.sort_by([("doc_id", "ascending"), ("text", "ascending")])
        order = np.random.default_rng(11).permutation(len(table))
        table = table.take(pa.array(order))
        weights = train(table["text"], (table["_label"].to_numpy() > 0).astype(float), passes)
        return pa.table({"rows": pa.array([len(table)], pa.int64()), "weights": pa.array([weights.tobytes()], pa.binary())})

    # A fixed number of shards: what reaches the driver has a fixed size.
    found = rows.groupBy("_shard").applyInArrow(one, "rows long, weights binary").collect()
    if not found:
        return None
    share = np.array([r["rows"] for r in found], float)
    return np.average([np.frombuffer(r["weights"]) for r in found], axis=0, weights=share)


def scores(data: np.ndarray, offsets: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Probability of a good text, per text."""
    index, value, owner = features(data, offsets)
    dots = np.bincount(owner, weights[index] * value, len(offsets) - 1)
    return 1 / (1 + np.exp(-np.clip(dots + weights[-1], -35, 35)))


def score(docs: DataFrame, weights: np.ndarray | None, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    A null or empty text has the score of the bias alone. Without any labelled row the score
    is 0.5. Repeated rows give repeated results; other columns are not read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(None if weights is None else weights.astype(np.float64))

    def apply(batches):
        w = sent.value
        for batch in batches:
            for row, end, data, offsets in bs.chunks(batch.column(1)):
                s = np.full(end - row, 0.5) if w is None else scores(data, offsets, w)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, end - row), pa.array(s)], ["doc_id", "score"])

    out = docs.select("doc_id", "text").mapInArrow(apply, f"doc_id {_type(docs)}, score double")
    return out.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def keep_good(docs: DataFrame, weights: np.ndarray | None, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, all columns as they are.

    Scores are computed next to the rows they belong to, so nothing is joined. Without a
    labelled row nothing is rejected.
    """
    if weights is None:
        return docs
    sent = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float64))
    place = docs.columns.index("text")

    def apply(batches):
        for batch in batches:
            for row, end, data, offsets in bs.chunks(batch.column(place)):
                good = scores(data, offsets, sent.value) >= threshold
                yield batch.slice(row, end - row).filter(pa.array(good))

    return docs.mapInArrow(apply, docs.schema)
