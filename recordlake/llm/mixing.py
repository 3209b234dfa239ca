"""Mixing sources to target weights.

The words of a source form one stream, cut into blocks of a fixed number of words. Targets in
words follow the weights, up to a number of repeats. Output shards of a fixed number of slots
draw multinomial source counts, with probabilities that follow what each source still needs,
so that the last shard brings every source to its number of slots. A source's slots are
mapped through a pseudorandom permutation of its block numbers, one full pass after the
other, and the blocks are joined by number. Same input and seed give the same mix.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recordlake.llm import bytesets as bs
from recordlake.llm.store import stored

WEIGHTS = (5, 2, 1)
REPEATS = 3
BLOCK_WORDS = 64
SLOTS_PER_SHARD = 4096
MAX_SHARDS = 2048
# Sizes and targets are planned on the driver, a row per source; up to MAX_SHARDS draws of every
# source come from one task. More sources than this are an error.
MAX_SOURCES = 1000
# Slots that one task fills. The rows that describe them are few bytes, so their number has
# to be asked for.
SLOTS_PER_TASK = 100_000
# Documents in the slice of a stream that one task numbers.
SLICE_ROWS = 20_000
WORD = r"[^\x20\x09-\x0D]+"
SOURCES = "source_no int, source string, source_size long, target double, n_blocks long, slots long"


def targets(sizes: list[int], weights: list[float], repeats: int = REPEATS) -> list[float]:
    """Targets that sum to the sizes' sum, by weight, none above ``repeats`` times its size."""
    out = [0.0] * len(sizes)
    left, active = float(sum(sizes)), set(range(len(sizes)))
    while active:
        total = sum(weights[i] for i in active)
        share = {i: left * weights[i] / total for i in active}
        over = {i for i in active if share[i] > repeats * sizes[i]}
        for i in over or active:
            out[i] = float(repeats * sizes[i]) if i in over else share[i]
        if not over:
            break
        left -= sum(repeats * sizes[i] for i in over)
        active -= over
    return out


def shard_counts(slots: np.ndarray, per_shard: int, seed: int) -> Iterator[tuple[int, int, int, int]]:
    """(shard, source number, first slot of the source, number of slots), zero counts left out."""
    rng = np.random.default_rng(seed)
    need, done, shard = slots.astype(np.int64).copy(), np.zeros(len(slots), np.int64), 0
    while (left := int(need.sum())) > 0:
        size = min(per_shard, left)
        draw = np.minimum(rng.multinomial(size, need / left), need)
        while (short := size - int(draw.sum())) > 0:  # a source drew more than it needs
            draw += np.minimum(rng.multinomial(short, (need - draw) / (need - draw).sum()), need - draw)
        yield from ((shard, int(i), int(done[i]), int(draw[i])) for i in np.flatnonzero(draw))
        done, need, shard = done + draw, need - draw, shard + 1


def permuted(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """A pseudorandom permutation of 0 .. n-1 applied to ``index``: a Feistel network on the
    next even number of bits, walked until the result is below ``n``."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    out, todo = index.astype(np.uint64), np.arange(len(index))
    while len(todo):
        left, right = out[todo] >> shift, out[todo] & mask
        for r in range(4):
            salt = np.array([(key * 4 + r) & (2**64 - 1)], np.uint64)
            left, right = right, left ^ (bs.mix(right + bs.mix(salt * bs.BASE)) & mask)
        out[todo] = left << shift | right
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


def word_count(text="text"):
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


class Mix:
    """One mixing run over ``docs`` (doc_id, text, source): plan it, then read its results.

    A null text has no words, null sources are one source. Rows that repeat a doc_id count
    each for themselves and are told apart by text. Empty tables give empty results. More
    than ``MAX_SOURCES`` sources are an error.
    """

    def __init__(self, docs: DataFrame, weights=WEIGHTS, repeats: int = REPEATS,
                 block_words: int = BLOCK_WORDS, seed: int = 17):
        self.spark: SparkSession = docs.sparkSession
        self.block, self.seed = block_words, seed
        self.sizes = stored(
            docs.select("doc_id", "source", word_count().alias("size"), F.xxhash64("text").alias("_hash")), "mix-sizes"
        )
        found = self.sizes.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("rows")).limit(MAX_SOURCES + 1).collect()
        if len(found) > MAX_SOURCES:
            raise ValueError(f"more than {MAX_SOURCES} sources to mix: merge sources first, the plan is made on the driver")
        found = sorted(found, key=lambda r: (r["source"] is None, r["source"] or ""))
        self.rows = sum(r["rows"] for r in found)
        size = [r["size"] for r in found]
        goal = targets(size, [weights[i % len(weights)] for i in range(len(found))], repeats)
        blocks = [-(-s // block_words) for s in size]
        # As many slots as come nearest to the target, given the mean words of a block.
        slots = [round(t * b / s) if s else 0 for t, b, s in zip(goal, blocks, size)]
        self.plan = [(i, r["source"], s, t, b, k) for i, (r, s, t, b, k) in enumerate(zip(found, size, goal, blocks, slots))]

    def sources(self) -> DataFrame:
        return self.spark.createDataFrame(self.plan, SOURCES)

    def placed(self) -> DataFrame:
        """Documents with the place of their first word in their source's stream.

        The stream of a source is ordered by hash slice, then id; a task numbers one slice,
        so a source with a third of all rows is spread over many tasks.
        """
        slices = max(1, -(-self.rows // SLICE_ROWS))
        place = F.pmod(F.xxhash64("doc_id", F.lit(self.seed)), F.lit(slices)).cast("int")
        rows = self._with_source_no().withColumn("_slice", place)
        before = Window.partitionBy("source_no").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
        base = (
            rows.groupBy("source_no", "_slice").agg(F.sum("size").alias("_sum"))
            .select("source_no", "_slice", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
        )
        inside = (
            Window.partitionBy("source_no", "_slice").orderBy("doc_id", "size", "_hash")
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        return (
            rows.withColumn("_inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
            .join(base, ["source_no", "_slice"])
            .withColumn("start", F.col("_base") + F.col("_inside"))
            .drop("_base", "_inside", "_slice")
        )

    def _with_source_no(self) -> DataFrame:
        # At most MAX_SOURCES rows; without the mark it is the documents that may be broadcast.
        named = F.broadcast(self.sources().select("source_no", F.col("source").alias("_source"), "source_size", "target"))
        return self.sizes.join(named, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")

    def drawn(self) -> DataFrame:
        """What each shard draws of each source, and where the draw begins in both. One task makes
        the draws, one shard after the other: they need not fit the driver."""
        counts, blocks = (np.array([p[i] for p in self.plan], np.int64) for i in (5, 4))
        per_shard = max(SLOTS_PER_SHARD, -(-int(counts.sum()) // MAX_SHARDS)) if len(counts) else 1
        seed = self.seed

        def draw(batches):
            names = ["shard", "source_no", "first", "n", "at", "n_blocks", "shard_slots"]
            for _ in batches:
                for shard, own in groupby(shard_counts(counts, per_shard, seed), lambda r: r[0]):
                    _, source, first, n = np.array(list(own), np.int64).T
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(n), shard, np.int32)), pa.array(source.astype(np.int32)),
                            pa.array(first), pa.array(n), pa.array(np.cumsum(n) - n),
                            pa.array(blocks[source]), pa.array(np.full(len(n), n.sum())),
                        ],
                        names,
                    )

        return (
            self.spark.range(1, numPartitions=1)
            .mapInArrow(draw, "shard int, source_no int, first long, n long, at long, n_blocks long, shard_slots long")
            .repartition(max(1, -(-int(counts.sum()) // SLOTS_PER_TASK)), "shard")
        )

    def slots(self) -> DataFrame:
        """(shard, slot, source_no, block_no, pass): every slot of the mix and what fills it."""
        seed = self.seed

        def fill(batches):
            names = ["shard", "slot", "source_no", "block_no", "pass"]
            for batch in batches:
                for shard, source, first, n, at, blocks, size in zip(*(c.to_pylist() for c in batch.columns)):
                    for low in range(0, n, 100_000):
                        k = np.arange(first + low, first + min(n, low + 100_000))
                        place = permuted(k - first + at, size, (seed << 20) + shard * 2 + 1)
                        block = permuted(k % blocks, blocks, (seed << 20) + source * 2)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(np.full(len(k), shard, np.int32)), pa.array(place),
                                pa.array(np.full(len(k), source, np.int32)), pa.array(block),
                                pa.array((k // blocks).astype(np.int32)),
                            ],
                            names,
                        )

        return self.drawn().mapInArrow(fill, "shard int, slot long, source_no int, block_no long, pass int")

    def pieces(self, placed: DataFrame) -> DataFrame:
        """The parts of documents that blocks consist of, joined to the slots by block number.

        Block numbers are spread evenly whatever the source, so the join has no hot key. Both
        sides are made from few bytes and hold many rows, so an estimate of their size, by which
        one might be broadcast, is far too low: the join is always a shuffle.
        """
        b = F.lit(self.block)
        parts = (
            placed.where("size > 0")
            .withColumn("block_no", F.explode(F.sequence(
                F.floor(F.col("start") / b), F.floor((F.col("start") + F.col("size") - 1) / b))))
            .withColumn("first_word", F.greatest(F.col("block_no") * b - F.col("start"), F.lit(0)))
            .withColumn("end_word", F.least((F.col("block_no") + 1) * b - F.col("start"), F.col("size")))
            .select("source_no", "block_no", "doc_id", "start", "first_word", "end_word")
        )
        return parts.hint("merge").join(self.slots().hint("merge"), ["source_no", "block_no"])

    def taken(self) -> DataFrame:
        """Per document: doc_id, size, source_size, target (its source's), taken (words)."""
        placed = stored(self.placed(), "mix-placed")
        sums = (
            self.pieces(placed).groupBy("source_no", "start")
            .agg(F.sum(F.col("end_word") - F.col("first_word")).alias("_taken"))
        )
        # Documents without words share their start with the next one; they take nothing.
        return placed.join(sums, ["source_no", "start"], "left").select(
            "doc_id", "size", "source_size", "target",
            F.when(F.col("size") > 0, F.coalesce("_taken", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("taken"),
        )

    def documents(self, docs: DataFrame) -> DataFrame:
        """The mix as rows like those of ``docs``: one per document and pass that takes words
        of it, with the words taken in that pass as text (and n_chars to match, if there)."""
        placed = stored(self.placed(), "mix-placed")
        runs = (
            self.pieces(placed).groupBy("source_no", "start")
            .agg(F.sort_array(F.collect_list(F.struct("pass", "first_word", "end_word"))).alias("_runs"))
        )
        copy = Window.partitionBy("_id").orderBy("_size", "_hash")
        # A null id cannot be joined, so it stands as a hash of its row's text.
        ident = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("null "), F.col("_hash").cast("string")))
        wanted = (
            placed.where("size > 0").withColumn("_id", ident).withColumnRenamed("size", "_size")
            .withColumn("_copy", F.row_number().over(copy))
            .join(runs, ["source_no", "start"]).select(F.col("_id").alias("_wid"), F.col("_copy").alias("_wcopy"), "_runs")
        )
        rows = (
            docs.withColumn("_size", word_count()).where("_size > 0")
            .withColumn("_hash", F.xxhash64("text")).withColumn("_id", ident).withColumn("_copy", F.row_number().over(copy))
        )
        # Not an equality of two columns, so that the rows stay where the window put them.
        same = (F.col("_id") == F.col("_wid")) & (F.col("_copy") - F.col("_wcopy") == 0)
        joined = rows.join(wanted, same).select(*docs.columns, "_runs")
        columns = docs.columns

        def cut(batches):
            for batch in batches:
                for row, end, data, offsets in bs.chunks(batch.column(columns.index("text"))):
                    starts, ends, word_offsets = bs.words(data, offsets)
                    runs = batch.column(len(columns)).slice(row, end - row).to_pylist()
                    which, texts = [], []
                    for i, own in enumerate(runs):
                        base, passes = word_offsets[i], {}
                        for run in own:
                            spans = passes.setdefault(run["pass"], [])
                            if spans and spans[-1][1] == run["first_word"]:
                                spans[-1][1] = run["end_word"]
                            else:
                                spans.append([run["first_word"], run["end_word"]])
                        for spans in passes.values():
                            which.append(row + i)
                            texts.append(b"\n".join(
                                data[starts[base + a] : ends[base + b - 1]].tobytes() for a, b in spans).decode("utf-8"))
                    out = batch.take(pa.array(which, pa.int64()))
                    arrays = dict(zip(out.schema.names, out.columns))
                    arrays["text"] = pa.array(texts, pa.string())
                    if "n_chars" in arrays:
                        arrays["n_chars"] = pa.array([len(t) for t in texts]).cast(arrays["n_chars"].type)
                    yield pa.RecordBatch.from_arrays([arrays[c] for c in columns], columns)

        return joined.mapInArrow(cut, docs.schema)
