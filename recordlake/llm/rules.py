"""Quality rules with an isolation forest on their statistics.

One pass over the texts gives rule statistics per document; they are stored, so that fitting
and judging read a few numbers per row only. Two base rules fail a document outright. For the
others the range of each statistic among all rows labelled good is taken, and an isolation
forest measures how few random splits isolate a document by what it has below or above these
ranges. Each tree is grown on its own random subsample of all rows, as the method has it. The
largest anomaly score still accepted is calibrated on all labelled rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recordlake.llm import bytesets as bs
from recordlake.llm.bpe import _type
from recordlake.llm.store import bounded, held_out, stored
from recordlake.session import pin

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
# Trees of the forest and rows of the subsample that each of them is grown on.
TREES, SUBSAMPLE = 200, 64
# Without labels: scores above this are anomalous. With labels: the least share of good ones
# that must be accepted.
DEFAULT_LIMIT = 0.65
KEEP_GOOD = 0.998

# Characters counted as symbols.
SYMBOLS = b"#*$%&|<>"
_IS_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))
_IS_UPPER = (np.arange(256) >= 65) & (np.arange(256) <= 90)
_IS_LETTER = _IS_UPPER | ((np.arange(256) >= 97) & (np.arange(256) <= 122)) | (np.arange(256) >= 128)
_IS_DIGIT = (np.arange(256) >= 48) & (np.arange(256) <= 57)
_IS_MARK = ~_IS_LETTER & ~_IS_DIGIT & ~bs.SPACE & (np.arange(256) > 32) & (np.arange(256) < 127)
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
# Of the range of a statistic among good rows, the share allowed beyond either end, and the
# least number of good rows that set ranges.
MARGIN = 0.1
MIN_GOOD = 30
# What the further rules allow where labels do not say.
ALLOWED = {
    "symbols": 0.1,  # symbols per word
    "marks": 0.6,  # other ASCII punctuation per word
    "upper": 0.3,  # capitals among letters
    "digits": 0.25,  # digits among characters in words
    "long_words": 12.0,  # mean characters of a word
    "dup_lines": 0.3,  # repeated lines among lines
    "repeats": 0.3,  # words in repeated 3-word windows
}
SHAPE = list(ALLOWED)


def _seen_before(keys: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per entry: is there an equal one earlier in its row, and any other at all?"""
    keys = bs.mix(keys + rows.astype(np.uint64) * bs.BASE)
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    earlier, other = np.zeros((2, len(keys)), bool)
    earlier[order[1:]] = same
    other[order[1:]] = same
    other[order[:-1]] |= same
    return earlier, other


def measure(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Base counts (texts x 5) and shape statistics (texts x 7) of a chunk of texts."""
    starts, ends, word_offsets = bs.words(data, offsets)
    n = len(offsets) - 1
    n_words = np.diff(word_offsets)
    heads = (data & 0xC0) != 0x80
    in_words = bs.row_sums(heads & ~bs.SPACE[data], offsets)
    per = lambda table: bs.row_sums(table[data] & heads, offsets)
    symbols, marks, upper, letters, digits = map(per, (_IS_SYMBOL, _IS_MARK, _IS_UPPER, _IS_LETTER, _IS_DIGIT))

    triples, at = bs.grams(bs.span_hashes(data, starts, ends), word_offsets, 3)
    _, repeated = _seen_before(triples, bs.row_ids(word_offsets)[at])
    covered = np.zeros(len(starts), bool)
    for k in range(3):
        covered[at[repeated] + k] = True
    n_repeat = bs.row_sums(covered, word_offsets)

    # Lines: from a text's start or after a line feed, up to the next one or the text's end.
    feeds = np.flatnonzero(data == 10)
    full = np.flatnonzero(np.diff(offsets))
    line_starts = np.unique(np.concatenate([offsets[:-1][full], feeds + 1]))
    line_starts = line_starts[line_starts < len(data)]
    stop = np.append(line_starts[1:], len(data))
    line_ends = np.where(data[stop - 1] == 10, stop - 1, stop) if len(stop) else stop
    rows = np.searchsorted(offsets, line_starts, "right") - 1
    has_word = np.searchsorted(starts, line_ends) > np.searchsorted(starts, line_starts)
    line_starts, line_ends, rows = line_starts[has_word], line_ends[has_word], rows[has_word]
    earlier, _ = _seen_before(bs.span_hashes(data, line_starts, line_ends), rows)
    n_dup, n_lines = np.bincount(rows[earlier], minlength=n), np.bincount(rows, minlength=n)

    base = np.stack([n_words, in_words, symbols, n_dup, n_repeat], 1).astype(np.int64)
    some = np.maximum(n_words, 1)
    shape = np.stack(
        [symbols / some, (marks - symbols) / some, upper / np.maximum(letters, 1), digits / np.maximum(in_words, 1),
         in_words / some, n_dup / np.maximum(n_lines, 1), n_repeat / some], 1,
    )
    return base, shape


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, the five base counts and the shape statistics, per row of ``docs``.

    A null or empty text has no words and zeros everywhere. Other columns are not read.
    """

    def apply(batches):
        for batch in batches:
            for row, end, data, offsets in bs.chunks(batch.column(1)):
                base, shape = measure(data, offsets)
                columns = [batch.column(0).slice(row, end - row), *map(pa.array, base.T.copy()), *map(pa.array, shape.T.copy())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", *BASE, *SHAPE])

    schema = ", ".join([f"doc_id {_type(docs)}", *(f"{c} long" for c in BASE), *(f"{c} double" for c in SHAPE)])
    return docs.select("doc_id", "text").mapInArrow(apply, schema)


def base_failed():
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


@dataclass
class Forest:
    """Trees as flat arrays: feature (-1 in a leaf), split value, children, path length."""

    feature: np.ndarray
    split: np.ndarray
    left: np.ndarray
    right: np.ndarray
    length: np.ndarray
    usual: float
    limit: float = DEFAULT_LIMIT
    low: np.ndarray | None = None
    high: np.ndarray | None = None

    def scores(self, x: np.ndarray) -> np.ndarray:
        """2 ** -(mean path length / usual path length): near 1 is anomalous."""
        total = np.zeros(len(x))
        for feature, split, left, right, length in zip(self.feature, self.split, self.left, self.right, self.length):
            node = np.zeros(len(x), np.int64)
            while (inner := feature[node] >= 0).any():
                go = x[np.arange(len(x)), np.maximum(feature[node], 0)] < split[node]
                node = np.where(inner, np.where(go, left[node], right[node]), node)
            total += length[node]
        return 2.0 ** (-total / (len(self.feature) * self.usual))


def so_far(rows: DataFrame, order_by: list[str], sums: list[str]) -> DataFrame:
    """``rows``, each with the sums of ``sums`` over all rows up to it, as ``<name>_so_far``.

    Rows are dealt by ranges and added up range by range; the driver sees a row per range.
    """
    placed = pin(rows.repartitionByRange(*order_by).withColumn("_part", F.spark_partition_id()))
    totals = placed.groupBy("_part").agg(*[F.sum(c).alias(c) for c in sums]).collect()
    ahead, at = [], [0] * len(sums)
    for r in sorted(totals, key=lambda r: r["_part"]):
        ahead.append((r["_part"], *at))
        at = [n + r[c] for n, c in zip(at, sums)]
    ddl = ", ".join(["_part int", *(f"{c}_so_far long" for c in sums)])
    before = rows.sparkSession.createDataFrame(ahead, ddl)
    within = Window.partitionBy("_part").orderBy(*order_by).rowsBetween(Window.unboundedPreceding, 0)
    joined = placed.join(F.broadcast(before), "_part")
    return joined.withColumns({f"{c}_so_far": F.col(f"{c}_so_far") + F.sum(c).over(within) for c in sums}).drop("_part")


def ranges(good: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Lowest and highest usual value of each statistic, given those of all good rows.

    They are quantiles between two neighbours in order, told from exact counts of every value.
    """
    n = good.count()
    if n < MIN_GOOD:
        return np.full(len(ALLOWED), -np.inf), np.array(list(ALLOWED.values()))
    values = good.select(F.posexplode(F.array(*SHAPE)).alias("_k", "_v")).groupBy("_k", "_v").agg(F.count(F.lit(1)).alias("n"))
    rank = F.col("n_so_far") - F.col("_k") * n  # of the value's last row; every statistic has n rows
    at = [(n - 1) * q for q in ((1 - KEEP_GOOD) / 2, (1 + KEEP_GOOD) / 2)]
    ranks = [min(int(p) + k, n - 1) for p in at for k in (0, 1)]
    found = so_far(values, ["_k", "_v"], ["n"]).groupBy("_k").agg(*[F.min(F.when(rank > r, F.col("_v"))).alias(f"_{i}") for i, r in enumerate(ranks)])
    around = np.array([tuple(r)[1:] for r in sorted(found.collect())], float)
    low, high = (np.array([np.quantile(pair, p % 1) for pair in around[:, 2 * i : 2 * i + 2]]) for i, p in enumerate(at))
    return low - MARGIN * (high - low), high + MARGIN * (high - low)


def outside(shape: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """By how much each statistic is above and below its range. Texts within all ranges are
    one point and are never isolated early."""
    return np.concatenate([np.maximum(shape - high, 0), np.maximum(low - shape, 0)], 1)


def _usual(n: int) -> float:
    """Mean path length of an unsuccessful search among n points."""
    return 0.0 if n < 2 else 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n if n > 2 else 1.0


def grow(x: np.ndarray, trees: int = TREES, subsample: int = SUBSAMPLE, seed: int = 5) -> Forest:
    """Isolation trees on random subsamples of the rows of ``x``; with enough rows no two trees
    share one."""
    rng = np.random.default_rng(seed)
    size = min(subsample, len(x))
    depth = int(np.ceil(np.log2(max(size, 2))))
    own = rng.permutation(len(x)) if len(x) >= trees * subsample else None
    grown = []
    for k in range(trees):
        nodes: list[list[float]] = []
        drawn = rng.choice(len(x), size, replace=False) if own is None else own[k * size : (k + 1) * size]
        todo = [(x[drawn], 0, None, 0)]
        while todo:
            points, level, parent, side = todo.pop()
            here = len(nodes)
            if parent is not None:
                nodes[parent][2 + side] = here
            low, high = points.min(0), points.max(0)
            open_features = np.flatnonzero(high > low)
            if level >= depth or len(points) < 2 or not len(open_features):
                nodes.append([-1, 0.0, 0, 0, level + _usual(len(points))])
                continue
            f = rng.choice(open_features)
            value = rng.uniform(low[f], high[f])
            nodes.append([f, value, 0, 0, 0.0])
            below = points[:, f] < value
            todo += [(points[below], level + 1, here, 0), (points[~below], level + 1, here, 1)]
        grown.append(np.array(nodes))
    part = lambda k, kind: [t[:, k].astype(kind) for t in grown]
    return Forest(part(0, int), part(1, float), part(2, int), part(3, int), part(4, float), max(_usual(size), 1e-9))


def calibrate(scores: DataFrame) -> float:
    """The limit with the best sum of accepted good and refused bad rows, among those that
    accept at least ``KEEP_GOOD`` of the good rows. ``scores`` has anomaly and _label (good: > 0).
    """
    good = F.col("_label") > 0
    cuts = scores.groupBy("anomaly").agg(F.count_if(good).alias("good"), F.count_if(~good).alias("bad"))
    n = cuts.agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"), F.max("anomaly").alias("most")).first()
    if not n["good"] or not n["bad"]:
        return n["most"] if n["good"] else DEFAULT_LIMIT
    placed = so_far(cuts, ["anomaly"], ["good", "bad"])
    accepted, refused = F.col("good_so_far") / F.lit(n["good"]), 1 - F.col("bad_so_far") / F.lit(n["bad"])
    value = F.when(accepted >= KEEP_GOOD, accepted + refused).otherwise(-1.0)
    best = placed.agg(F.max(F.struct(value.alias("value"), "anomaly")).alias("best")).first()["best"]["anomaly"]
    above = cuts.where(F.col("anomaly") > best).agg(F.min("anomaly").alias("next")).first()["next"]
    return best if above is None else (best + above) / 2


def fit(stats: DataFrame, labels: DataFrame) -> Forest | None:
    """A forest on subsamples of all rows of ``stats``; ranges and limit from all labelled rows.

    Only rows that pass the base rules are used. Labelled rows with crc32(doc_id) mod 4 = 2
    are held out; of conflicting labels the smaller counts, null labels are left out. None if
    no row passes the base rules.
    """
    usable = stats.where(~base_failed() & F.col("doc_id").isNotNull()).select("doc_id", *SHAPE)
    # As many rows as all trees draw, by the hash of their ids.
    points = np.array([tuple(r)[1:] for r in bounded(usable, "doc_id", TREES * SUBSAMPLE).collect()], float)
    if not len(points):
        return None
    known = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id").agg(F.min("quality").alias("_label"))
    )
    labelled = stored(usable.join(known, "doc_id").dropDuplicates(["doc_id"]).drop("doc_id"), "rules-labelled")
    low, high = ranges(labelled.where("_label > 0"))
    forest = grow(outside(points, low, high))
    forest.low, forest.high = low, high
    if not labelled.isEmpty():
        forest.limit = calibrate(scored(labelled, forest, ["_label"]))
    return forest


def scored(rows: DataFrame, forest: Forest | None, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of ``rows`` and anomaly, the forest's score."""
    sent = rows.sparkSession.sparkContext.broadcast(forest)

    def apply(batches):
        for batch in batches:
            x = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in range(len(keep), batch.num_columns)], 1)
            f = sent.value
            anomaly = f.scores(outside(x, f.low, f.high)) if f is not None else np.zeros(len(x))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(anomaly)], [*keep, "anomaly"])

    kinds = dict(rows.dtypes)
    schema = ", ".join([*(f"{c} {kinds[c]}" for c in keep), "anomaly double"])
    return rows.select(*keep, *SHAPE).mapInArrow(apply, schema)


def judge(stats: DataFrame, forest: Forest | None) -> DataFrame:
    """``stats`` with base_failed, anomaly (the forest's score) and kept."""
    limit = F.lit(forest.limit if forest is not None else 1.0)
    return (
        scored(stats, forest, ["doc_id", *BASE])
        .withColumn("base_failed", base_failed())
        .withColumn("kept", ~F.col("base_failed") & (F.col("anomaly") <= limit))
    )


def apply_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Base counts, base_failed, anomaly and kept for every row of ``docs``.

    An empty table gives an empty table; repeated rows give repeated results.
    """
    stats = stored(statistics(docs), "rules")
    return judge(stats, fit(stats, labels))
