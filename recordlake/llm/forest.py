"""MinHash near-duplicates through an LSH forest.

A document is the set of its distinct word shingles. Equal sets are one class and only its
smallest id goes on. Every tree of the forest sorts the classes by its own sequence of MinHash
values; documents that share a prefix of at least ``MIN_DEPTH`` values are a region. Regions
are searched from the deepest prefixes to the shallowest: first every document meets its
neighbours in the sorted orders, where common prefixes are longest, and takes the most alike
one. What these links join needs no further comparison. Where regions still hold several
components, every document outside a region's largest one takes its most alike partner of
another component there, twice over; so large groups of near copies, whose regions would hold
all pairs, are settled by a number of pairs that follows their size. The regions that are
left are then searched for all pairs of different components. Every candidate pair is
confirmed on the full sets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlake.llm import bytesets as bs
from recordlake.llm.bpe import _type
from recordlake.llm.components import components
from recordlake.llm.store import release, small, stored

DEPTH, MIN_DEPTH = 6, 4
# The share of pairs at the threshold that may be together in no region: that of 14 trees at 85%.
MISSED = (1 - 0.85**MIN_DEPTH) ** 14


def missed(percent: int, trees: int) -> float:
    """The share of pairs at the threshold that share ``MIN_DEPTH`` values in none of the trees."""
    return (1 - (percent / 100) ** MIN_DEPTH) ** trees


def tree_count(percent: int) -> int:
    """The fewest trees with which no more than ``MISSED`` of the pairs at the threshold are missed."""
    trees = 1
    while missed(percent, trees) > MISSED:
        trees += 1
    return trees


# Pairs whose signatures agree less than this often are not confirmed: at the threshold that
# is more than four standard deviations below the mean.
def least_agreement(percent: int) -> int:
    p, n = percent / 100, tree_count(percent) * DEPTH
    return int(n * p - 4 * (n * p * (1 - p)) ** 0.5)


def _hash_family(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(97)
    factors = rng.integers(1, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return factors, rng.integers(0, 2**63, n, dtype=np.uint64)


LEFT, RIGHT = 256, 2048


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of each text, sorted within it, and n + 1 offsets.

    A text with fewer words than ``size`` has its whole sequence as only shingle.
    """
    starts, ends, word_offsets = bs.words(data, offsets)
    hashes = bs.span_hashes(bs.LOWER[data], starts, ends)
    n_words = np.diff(word_offsets)
    found, at = bs.grams(hashes, word_offsets, size)
    rows = bs.row_ids(word_offsets)[at]
    for n in range(1, size):
        short, first = bs.grams(hashes, word_offsets, n)
        own = bs.row_ids(word_offsets)[first]
        whole = n_words[own] == n
        found = np.concatenate([found, bs.mix(short[whole] + np.uint64(n))])
        rows = np.concatenate([rows, own[whole]])
    order = np.lexsort((found, rows))
    found, rows = found[order], rows[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (rows[1:] != rows[:-1])
    found, rows = found[new], rows[new]
    return found, np.searchsorted(rows, np.arange(len(offsets)))


def signatures(docs: DataFrame, size: int, trees: int) -> DataFrame:
    """(doc_id, n_shingles, d1, d2, signature): a digest of the set and its MinHash values."""
    factors, terms = _hash_family(trees * DEPTH)

    def sign(batches):
        for batch in batches:
            for row, end, data, offsets in bs.chunks(batch.column(1)):
                found, cuts = shingle_sets(data, offsets, size)
                n = np.diff(cuts)
                full = np.flatnonzero(n)
                digests = np.zeros((2, end - row), np.uint64)
                low = np.zeros((end - row, trees * DEPTH), ">u4")
                if len(full):
                    digests[0, full] = np.add.reduceat(found, cuts[full])
                    digests[1, full] = np.add.reduceat(bs.mix(found + bs.BASE), cuts[full])
                    for k in range(trees * DEPTH):
                        values = ((found ^ terms[k]) * factors[k]) >> np.uint64(32)
                        low[full, k] = np.minimum.reduceat(values, cuts[full])
                raw = [r.tobytes() if n[i] else None for i, r in enumerate(low)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, end - row), pa.array(n), *(pa.array(d.view(np.int64)) for d in digests), pa.array(raw, pa.binary())],
                    ["doc_id", "n_shingles", "d1", "d2", "signature"],
                )

    schema = f"doc_id {_type(docs)}, n_shingles long, d1 long, d2 long, signature binary"
    return docs.select("doc_id", "text").mapInArrow(sign, schema)


def classes(signed: DataFrame) -> DataFrame:
    """One row per distinct non-empty set: its smallest id and its signature."""
    return (
        signed.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("d1", "d2", "n_shingles")
        .agg(F.min("doc_id").alias("rep"), F.min("signature").alias("signature"))
    )


def regions(reps: DataFrame, trees: int) -> DataFrame:
    """(tree, region, key, rep): the documents of every region with at least two of them."""
    keys = F.transform(
        F.sequence(F.lit(0), F.lit(trees - 1)),
        lambda t: F.struct(
            t.alias("tree"),
            F.substring(F.col("signature"), t * (4 * DEPTH) + 1, F.lit(4 * DEPTH)).alias("key"),
        ),
    )
    keyed = (
        reps.select("rep", F.explode(keys).alias("t")).select("rep", "t.tree", "t.key")
        # A region's name: tree and prefix in 64 bits. Names that fall together by chance
        # only mean a few more candidates.
        .withColumn("region", F.xxhash64("tree", F.substring("key", 1, 4 * MIN_DEPTH)))
    )
    shared = keyed.groupBy("region").agg(F.count("*").alias("_n")).where("_n > 1").select("region")
    return keyed.join(shared, "region")


def neighbours(forest: DataFrame) -> DataFrame:
    """(a, b): documents that follow each other in a tree's sorted order, within a region.

    The order is dealt out by range, so a region of any size spreads over tasks. The first
    and last row of each range partition are paired in a second step.
    """
    ordered = forest.select("tree", "region", "key", "rep").repartitionByRange("tree", "region", "key", "rep").sortWithinPartitions(
        "tree", "region", "key", "rep"
    )
    id_type = _type(forest, "rep")

    def pair(batches):
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            region, rep = batch.column(1).to_numpy(), batch.column(3)
            same = np.flatnonzero(region[1:] == region[:-1])
            a, b = rep.take(pa.array(same)), rep.take(pa.array(same + 1))
            yield row(a, b, region[same], np.zeros(len(same), np.int32))
            head = batch.slice(0, 1)
            if last is None:  # kind 1: where a partition begins, 2: where it ends
                yield row(head.column(3), head.column(3), head.column(1), np.ones(1, np.int32), head.column(2))
            elif last.column(1)[0] == head.column(1)[0]:
                yield row(last.column(3), head.column(3), head.column(1), np.zeros(1, np.int32))
            last = batch.slice(batch.num_rows - 1, 1)
        if last is not None:
            yield row(last.column(3), last.column(3), last.column(1), np.full(1, 2, np.int32), last.column(2))

    def row(a, b, region, kind, key=None):
        key = key if key is not None else pa.nulls(len(a), pa.binary())
        return pa.RecordBatch.from_arrays([a, b, pa.array(region), pa.array(kind), key], ["a", "b", "region", "kind", "key"])

    found = stored(ordered.mapInArrow(pair, f"a {id_type}, b {id_type}, region long, kind int, key binary"), "neighbours")
    # Two rows per range partition: small whatever the input.
    heads = found.where("kind = 1").groupBy("region").agg(F.collect_list(F.struct("key", "a")).alias("heads"))
    tails = found.where("kind = 2").groupBy("region").agg(F.collect_list(F.struct("key", "a")).alias("tails"))
    borders = (
        tails.join(heads, "region").select(F.explode("tails").alias("t"), "heads")
        .select(
            F.col("t.a").alias("a"),
            F.array_min(F.filter("heads", lambda h: (h["key"] > F.col("t.key")) | ((h["key"] == F.col("t.key")) & (h["a"] > F.col("t.a")))))["a"].alias("b"),
        ).where("b IS NOT NULL")
    )
    return found.where("kind = 0").select("a", "b").unionByName(borders).where("a <> b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    )


def agreement(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """``pairs`` with the number of equal MinHash values."""
    sides = [reps.select(F.col("rep").alias(c), F.col("signature").alias(f"_{c}")) for c in "ab"]
    both = pairs.join(sides[0], "a").join(sides[1], "b").select("a", "b", "_a", "_b")
    id_type = _type(pairs, "a")

    def count(batches):
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(k).to_pylist()), "<u4").reshape(batch.num_rows, -1) for k in (2, 3))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array((x == y).sum(1).astype(np.int32))], ["a", "b", "alike"])

    return both.mapInArrow(count, f"a {id_type}, b {id_type}, alike int")


def confirmed(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar enough."""
    sides = [texts.select(F.col("doc_id").alias(c), F.col("text").alias(f"_{c}")) for c in "ab"]
    both = pairs.join(sides[0], "a").join(sides[1], "b").select("a", "b", "_a", "_b")
    id_type = _type(pairs, "a")

    def check(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                n = np.arange(part.num_rows)
                good = _similar(pa.chunked_array([part.column(2), part.column(3)]), n, n + len(n), size, percent)
                yield part.select(["a", "b"]).filter(pa.array(good))

    return both.mapInArrow(check, f"a {id_type}, b {id_type}")


def _similar(texts: pa.ChunkedArray, a: np.ndarray, b: np.ndarray, size: int, percent: int) -> np.ndarray:
    """Which pairs of rows have shingle sets that are similar enough."""
    rows, which = np.unique(np.concatenate([a, b]), return_inverse=True)
    sets = []
    for _, _, data, offsets in bs.chunks(texts.take(pa.array(rows))):
        found, cuts = shingle_sets(data, offsets, size)
        sets += [found[i:j] for i, j in zip(cuts, cuts[1:])]
    good = np.zeros(len(a), bool)
    for k, (i, j) in enumerate(zip(which[: len(a)], which[len(a) :])):
        x, y = sets[i], sets[j]
        if 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)):
            common = len(np.intersect1d(x, y, assume_unique=True))
            good[k] = common > 0 and 100 * common >= percent * (len(x) + len(y) - common)
    return good


def across(
    forest: DataFrame, parts: DataFrame, reps: DataFrame, percent: int, size: int, texts: DataFrame | None = None
) -> DataFrame:
    """Pairs (a, b) of different components within a region.

    In each region the rows outside its largest component meet all rows, so the work follows
    the region's size times what is not settled yet. Rows are dealt in blocks of bounded size.
    Without ``texts`` each of these rows takes its most alike partner in the region, as a
    candidate. With ``texts`` all pairs are tried, each in the first tree in which the two
    share a region, and confirmed on the full sets where they meet: only links come back.
    """
    least, best = least_agreement(percent), texts is None
    rows = (
        forest.select("tree", "region", "rep")
        .join(parts.withColumnRenamed("id", "rep"), "rep", "left")
        .withColumn("component", F.coalesce("component", "rep"))
    )
    per = rows.groupBy("region", "component").agg(F.count("*").alias("n"))
    sizes = per.groupBy("region").agg(
        F.count("*").alias("_parts"), F.sum("n").alias("_rows"), F.max(F.struct("n", "component")).alias("_top")
    ).where("_parts > 1").select(
        "region", F.col("_top.component").alias("_main"),
        F.ceil((F.col("_rows") - F.col("_top.n")) / LEFT).cast("int").alias("_lefts"),
        F.ceil(F.col("_rows") / RIGHT).cast("int").alias("_rights"),
    )
    mixed = rows.join(sizes, "region").join(reps.select("rep", "signature"), "rep")
    place = F.xxhash64("rep", F.lit(5))
    common = ["tree", "region", "rep", "component", "signature"]
    if not best:
        mixed = mixed.join(texts.select(F.col("doc_id").alias("rep"), "text"), "rep")
        common.append("text")
    minor = mixed.where("component <> _main").select(
        *common, F.lit(True).alias("left"), F.pmod(place, F.col("_lefts")).cast("int").alias("i"),
        F.explode(F.sequence(F.lit(0), F.col("_rights") - 1)).alias("j"))
    every = mixed.select(
        *common, F.lit(False).alias("left"), F.explode(F.sequence(F.lit(0), F.col("_lefts") - 1)).alias("i"),
        F.pmod(place, F.col("_rights")).cast("int").alias("j"))
    id_type = _type(forest, "rep")

    def meet(table):
        left = table["left"].to_numpy()
        ids, part = table["rep"].to_numpy(), table["component"].to_numpy()
        signs = np.frombuffer(b"".join(table["signature"].to_pylist()), "<u4").reshape(len(ids), -1)
        x, y = np.flatnonzero(left), np.flatnonzero(~left)
        # Tree by tree, the values that name a document's region.
        names = signs.reshape(len(ids), -1, DEPTH)[:, : table["tree"][0].as_py(), :MIN_DEPTH]
        a, b = [x[:0]], [y[:0]]
        for s in range(0, len(x), 16):
            own = x[s : s + 16]
            alike = np.zeros((len(own), len(y)), np.int16)
            for k in range(signs.shape[1]):
                alike += signs[own, k][:, None] == signs[y, k][None, :]
            alike[part[own][:, None] == part[y][None, :]] = 0
            if best:
                j = alike.argmax(1)
                i = np.flatnonzero(alike[np.arange(len(own)), j] >= least)
                j = j[i]
            else:
                i, j = np.nonzero(alike >= least)
                met = (names[own[i]] == names[y[j]]).all(2).any(1)
                i, j = i[~met], j[~met]
            a.append(own[i])
            b.append(y[j])
        a, b = np.concatenate(a), np.concatenate(b)
        if not best:
            good = _similar(table["text"], a, b, size, percent)
            a, b = a[good], b[good]
        a, b = ids[a], ids[b]
        kind = table.schema.field("rep").type
        return pa.table({"a": pa.array(np.minimum(a, b), kind), "b": pa.array(np.maximum(a, b), kind)})

    dealt = minor.unionByName(every).groupBy("region", "i", "j")
    return dealt.applyInArrow(meet, f"a {id_type}, b {id_type}").distinct()


def near_duplicates(docs: DataFrame, size: int = 3, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs`` (doc_id, text).

    Shingles are ``size`` words; documents with 100 * intersection >= percent * union are
    linked. A null text, or one without words, has an empty set and is linked with nothing.
    Rows with the same id are one node, linked if any of their texts is. A null id has a null
    component and is kept. Other columns are not read; an empty table gives an empty table.
    """
    return _result(*_linked(docs, size, percent))


def _linked(docs: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Signed documents, their classes and the components of linked classes, all stored."""
    trees = tree_count(percent)
    signed = stored(signatures(docs, size, trees), "signed")
    reps = stored(classes(signed), "classes")
    forest = stored(regions(reps, trees), "forest")
    near = small(forest.select("rep").distinct())
    texts = stored(
        docs.select("doc_id", "text").join(near, F.col("doc_id") == F.col("rep"), "left_semi"), "forest-texts"
    )
    least = least_agreement(percent)
    # First every document with its most alike neighbour.
    alike = agreement(neighbours(forest).distinct(), reps).where(F.col("alike") >= least)
    ends = alike.select(F.col("a").alias("x"), F.col("b").alias("y"), "alike").unionByName(
        alike.select(F.col("b").alias("x"), F.col("a").alias("y"), "alike")
    )
    best = ends.groupBy("x").agg(F.max(F.struct("alike", "y")).alias("m")).select(
        F.least("x", "m.y").alias("a"), F.greatest("x", "m.y").alias("b")
    ).distinct()
    links = stored(confirmed(best, texts, size, percent).select(F.col("a").alias("u"), F.col("b").alias("v")), "forest-links")
    parts = components(links)
    # Then across components: best partners, then all pairs of what is left.
    for last in (False, False, True):
        if last:
            more = across(forest, parts, reps, percent, size, texts)
        else:
            more = confirmed(across(forest, parts, reps, percent, size), texts, size, percent)
        more = stored(more.select(F.col("a").alias("u"), F.col("b").alias("v")), "forest-links")
        if not more.isEmpty():
            parts = components(parts.select(F.col("id").alias("u"), F.col("component").alias("v")).unionByName(more))
    release(forest, texts, links)
    return signed, reps, parts


def keep_first(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without the documents whose group has a smaller id, columns as they are.

    Rows with the same id stay or go together; rows with a null id stay.
    """
    linked = _linked(docs, size, percent)
    gone = _result(*linked).where("NOT kept").select(F.col("doc_id").alias("_gone")).distinct()
    gone = small(stored(gone, "near-copies"))
    release(*linked)
    return docs.join(gone, F.col("doc_id") == F.col("_gone"), "left_anti")


def _result(signed: DataFrame, reps: DataFrame, parts: DataFrame) -> DataFrame:
    named = reps.join(parts, reps["rep"] == parts["id"], "left").select(
        F.col("d1").alias("_d1"), F.col("d2").alias("_d2"), F.col("n_shingles").alias("_n"),
        F.coalesce("component", "rep").alias("_component"),
    )
    same = (F.col("d1") == F.col("_d1")) & (F.col("d2") == F.col("_d2")) & (F.col("n_shingles") == F.col("_n"))
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("_component", "doc_id"))
    return signed.select("doc_id", "n_shingles", "d1", "d2").join(named, same, "left").select(
        "doc_id", "n_shingles", own.alias("component_id"),
        F.coalesce(F.col("doc_id") == own, F.lit(True)).alias("kept"),
    )
