"""Embedding near-duplicates through an exact pivot index.

Reference points (pivots) are a bounded sample of the vectors, thinned so that no two of them
are as alike as linked vectors. Every vector is at home on the list of its nearest pivot. It
also visits the list of every pivot with a smaller number for which a vector at home there
could be linked with it: linked vectors are at most an angle apart, so the plane half-way
between the two pivots, which the arc from one to the other crosses, is within that angle of
both. So two linked vectors always meet, whatever the density around them, once, on the list
of the smaller of their homes; there rows at home meet each other and the visitors. Long lists
are cut into blocks, and the pairs of blocks are dealt out, so no task holds more than two
blocks of a list. A pair of blocks is compared by cosine in double precision and returns link
counts and a spanning star per local component instead of pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlake.llm.bpe import _type
from recordlake.llm.components import components, local_components
from recordlake.llm.store import bounded, stored

THRESHOLD = 0.93
# Bounds of the index: pivots, and rows per pivot of the largest label.
MAX_PIVOTS = 2048
MIN_PIVOTS = 8
CELL = 8192
# Rows of a block that share one matrix product, rows of a block, and numbers in one.
SHARED = 256
BLOCK = 8192
BLOCK_VALUES = 1 << 19
# Rows of a block on lists with more than so many vectors of ids that have several.
SMALL_BLOCK, SEVERAL = 1024, 128
# Far more than rounding moves a cosine.
SLACK = 1e-9


def usable_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, dim, v array<double>, several) of the vectors that can have links.

    Left out: null ids, labels or vectors, vectors with a null, NaN or infinite component,
    zero vectors. Rows that repeat a vec_id with another label or vector all stay and are
    marked as ``several``; equal rows are one.
    """
    v = F.col("embedding").cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = vectors.select("vec_id", "label", v.alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()
        & fine & F.exists("v", lambda x: x != 0)
    )
    rows = stored(rows.distinct(), "distinct-vectors")
    many = rows.groupBy("vec_id").agg(F.count("*").alias("_n")).where("_n > 1").select("vec_id", F.lit(True).alias("_many"))
    return rows.join(many, "vec_id", "left").select(
        "vec_id", "label", F.size("v").alias("dim"), "v", F.coalesce("_many", F.lit(False)).alias("several")
    )


def _matrix(column, dim: int) -> np.ndarray:
    """Unit rows, scaled first so that squares neither overflow nor vanish."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    x = np.asarray(column.flatten(), np.float64).reshape(-1, dim)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def thinned(x: np.ndarray, threshold: float, count: int) -> np.ndarray:
    """At most ``count`` of the unit rows, none with a cosine of ``threshold`` to an earlier one."""
    kept = np.empty((min(count, len(x)), x.shape[1]))
    n = 0
    for row in x:
        if n < len(kept) and (n == 0 or (kept[:n] @ row).max() < threshold):
            kept[n] = row
            n += 1
    return kept[:n]


def choose_pivots(rows: DataFrame, threshold: float = THRESHOLD) -> dict[int, np.ndarray]:
    """Unit pivots by dimension, in the order of a hash of the id and thinned."""
    sizes = rows.groupBy("dim", "label").count().groupBy("dim").agg(F.sum("count").alias("n"), F.max("count").alias("top"))
    found = {}
    for dim, _, top in sizes.orderBy(F.desc("n"), "dim").limit(16).collect():
        count = min(MAX_PIVOTS, max(MIN_PIVOTS, -(-top // CELL)))
        picked = bounded(rows.where(F.col("dim") == dim).select("vec_id", "v"), "vec_id", min(4 * count, 2 * MAX_PIVOTS)).collect()
        x = np.array([r["v"] for r in picked]).reshape(-1, dim)
        x = x / np.abs(x).max(1, keepdims=True)
        found[dim] = thinned(x / np.sqrt((x * x).sum(1, keepdims=True)), threshold, count)
    return found


def visited(cosine: np.ndarray, gaps: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Per row of cosines with the pivots its home, and which pivots' lists it visits.

    ``gaps`` has the distances between pivots. The sine of the angle between a vector and the
    plane half-way between its home and another pivot is the difference of its cosines with
    them over their distance.
    """
    home = cosine.argmax(1)
    reach = (1 - threshold**2) ** 0.5 if threshold > 0 else 1.0
    nearer = cosine[np.arange(len(home)), home][:, None] - cosine
    return home, (nearer <= reach * gaps[home] + SLACK) & (np.arange(cosine.shape[1]) < home[:, None])


def inverted_lists(rows: DataFrame, pivots: dict[int, np.ndarray], threshold: float = THRESHOLD) -> DataFrame:
    """``rows`` with pivot and visitor, one row per list that a vector is on.

    Vectors of a dimension without pivots share one list, so they are still compared.
    """
    sent = rows.sparkSession.sparkContext.broadcast(pivots)

    def describe(batches):
        gaps = {d: np.sqrt(np.maximum(2 - 2 * (p @ p.T), 0)) for d, p in sent.value.items()}
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                dims = part.column(2).to_numpy()
                home, lists = np.zeros(part.num_rows, np.int32), [[]] * part.num_rows
                for dim in np.unique(dims):
                    p = sent.value.get(int(dim))
                    if p is None:
                        continue
                    own = np.flatnonzero(dims == dim)
                    cosine = _matrix(part.column(3).take(pa.array(own)), int(dim)) @ p.T
                    home[own], wanted = visited(cosine, gaps[int(dim)], threshold)
                    for i, w in zip(own, wanted):
                        lists[i] = np.flatnonzero(w).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(home), pa.array(lists, pa.list_(pa.int32()))], names)

    names = ["vec_id", "label", "dim", "v", "several", "home", "visits"]
    schema = (
        f"vec_id {_type(rows, 'vec_id')}, label {_type(rows, 'label')}, dim int, v array<double>, "
        "several boolean, home int, visits array<int>"
    )
    # Written, so that every reader sees the same homes, however products are rounded.
    described = stored(rows.select("vec_id", "label", "dim", "v", "several").mapInArrow(describe, schema), "vector-homes")
    place = F.explode(F.concat(
        F.array(F.struct(F.col("home").alias("pivot"), F.lit(False).alias("visitor"))),
        F.transform("visits", lambda p: F.struct(p.alias("pivot"), F.lit(True).alias("visitor"))),
    ))
    columns = names[:5]
    return described.select(*columns, place.alias("_p")).select(*columns, "_p.*")


def links(lists: DataFrame, threshold: float = THRESHOLD, shared: int = SHARED, block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, root, other): per vector and pair of blocks, verified links and the
    smallest vec_id of its component among the block's links. Vectors without a link do not
    appear. A link of an id that has several vectors may be found again with another of them,
    so it is not counted but comes as a row per end, with the id at the other end."""
    keys = ["label", "dim", "pivot"]
    # Links of ids with several vectors come as rows, so lists with many of them have small blocks.
    most = F.when(F.count_if("several") > SEVERAL, F.least(F.lit(block), F.lit(SMALL_BLOCK))).otherwise(F.lit(block))
    room = F.greatest(F.lit(1), F.least(most, F.floor(F.lit(BLOCK_VALUES) / F.col("dim"))))
    sizes = lists.groupBy(*keys).agg(
        F.ceil(F.count_if(~F.col("visitor")) / room).cast("int").alias("_homes"),
        F.ceil(F.count_if("visitor") / room).cast("int").alias("_visitors"),
    ).where("_homes > 0")
    blocks = F.when(F.col("visitor"), F.col("_visitors")).otherwise(F.col("_homes"))
    mine = F.col("_mine")

    def met(n, low, high, across):
        found = F.transform(
            F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))),
            lambda o: F.struct(low(o).alias("_low"), high(o).alias("_high"), F.lit(across).alias("_across")),
        )
        return F.slice(found, F.lit(1), n)

    at_home = F.concat(
        met(F.col("_homes"), lambda o: F.least(mine, o), lambda o: F.greatest(mine, o), False),
        met(F.col("_visitors"), lambda o: mine, lambda o: o, True),
    )
    visiting = met(F.col("_homes"), lambda o: o, lambda o: mine, True)
    dealt = (
        lists.join(sizes, keys).withColumn("_mine", F.pmod(F.xxhash64("vec_id", "v", F.lit(23)), blocks).cast("int"))
        .withColumn("_met", F.explode(F.when(F.col("visitor"), visiting).otherwise(at_home)))
        .select("vec_id", "v", "several", "visitor", "_mine", *keys, "_met.*")
    )
    id_type = _type(lists, "vec_id")

    def compare(key, table):
        dim, low, high, across = (key[i].as_py() for i in (1, 3, 4, 5))
        ids = table["vec_id"].to_numpy()
        x = _matrix(table["v"], dim)
        mine, visitor = table["_mine"].to_numpy(), table["visitor"].to_numpy()
        if across:
            a, b = np.flatnonzero(~visitor), np.flatnonzero(visitor)
        else:
            a, b = np.flatnonzero(mine == low), np.flatnonzero(mine == high)
        same = not across and low == high
        several = table["several"].to_numpy()
        ends = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        y = x[b]
        n, part_of = np.zeros(len(ids), np.int64), np.arange(len(ids))
        for s in range(0, len(a), shared):
            own = a[s : s + shared]
            # Within a block every pair once: later rows only.
            rest, others = (b[s:], y[s:]) if same else (b, y)
            good = x[own] @ others.T >= threshold
            if same:
                good &= own[:, None] < rest[None, :]
            twice = good & (several[own][:, None] | several[rest][None, :])
            i, j = np.nonzero(twice)
            ends[0].append(own[i])
            ends[1].append(rest[j])
            n[own] += good.sum(1) - twice.sum(1)
            n[rest] += good.sum(0) - twice.sum(0)
            # Links inside a component that is known by now add nothing to it.
            i, j = np.nonzero(good & (part_of[own][:, None] != part_of[rest][None, :]))
            if len(i):
                every = np.arange(len(ids))
                part_of = local_components(
                    len(ids), np.concatenate([every, own[i]]), np.concatenate([part_of, rest[j]])
                )
        by_id = np.argsort(ids, kind="stable")
        rank = np.empty(len(ids), int)
        rank[by_id] = np.arange(len(ids))
        lowest = np.full(len(ids), len(ids))
        np.minimum.at(lowest, part_of, rank)
        root = ids[by_id][lowest[part_of]]
        linked = np.flatnonzero(n)
        left, right = map(np.concatenate, ends)
        rows = np.concatenate([linked, left, right])
        kind = table.schema.field("vec_id").type
        return pa.table({
            "vec_id": pa.array(ids[rows], kind),
            "n_links": pa.array(np.where(np.arange(len(rows)) < len(linked), n[rows], 0), pa.int64()),
            "root": pa.array(root[rows], kind),
            "other": pa.concat_arrays([pa.nulls(len(linked), kind), pa.array(ids[np.concatenate([right, left])], kind)]),
        })

    schema = f"vec_id {id_type}, n_links long, root {id_type}, other {id_type}"
    return dealt.groupBy(*keys, "_low", "_high", "_across").applyInArrow(compare, schema)


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``vectors``.

    Vectors that cannot be compared have no links and are their own component. Rows that
    repeat a vec_id are one node, linked if any of its vectors is; n_links counts the other
    ids it is linked with, each once. A null vec_id has a null component and is kept.
    """
    rows = stored(usable_vectors(vectors), "vectors")
    lists = inverted_lists(rows, choose_pivots(rows, threshold), threshold)
    found = stored(links(lists, threshold), "vector-links")
    again = found.where("other <> vec_id").select("vec_id", "other").distinct().select("vec_id", F.lit(1).alias("n_links"))
    total = found.select("vec_id", "n_links").unionByName(again).groupBy("vec_id").agg(F.sum("n_links").alias("_n"))
    parts = components(found.select(F.col("vec_id").alias("u"), F.col("root").alias("v")))
    result = total.join(parts.withColumnRenamed("id", "vec_id"), "vec_id", "left").withColumnRenamed("vec_id", "_id")
    own = F.coalesce(F.col("component"), F.col("vec_id"))
    return vectors.select("vec_id").join(result, F.col("vec_id") == F.col("_id"), "left").select(
        "vec_id", F.coalesce("_n", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"),
        F.coalesce(F.col("vec_id") == own, F.lit(True)).alias("kept"),
    )
