"""Vector code compression: parts of integer vectors replaced by codebook entries found in GNATs.

Vectors become integers and are cut into parts; every part position has a codebook that is
trained by rounds of nearest-entry assignment and integer means. The nearest entry is looked
up in a geometric near-neighbour access tree over the codebook's entries: a node has a few
split points, every other entry hangs below its nearest split point, and for each pair of a
split point and a subtree the smallest and largest distance between them is stored. A query
that is at distance d from a split point and has an entry at distance r cannot find one as
near in a subtree whose distances to the split point all lie outside d - r to d + r. Stored
ranges and r are widened by more than rounding can move them and the comparison is strict, so
a subtree that could hold an equally near entry is always entered; which of two entries is
nearer, and ties, are decided on squared distances in integers, the lower index first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlake.llm.bpe import _type
from recordlake.llm.store import stored

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
# Integers are cut to this size, so that squared distances of a part fit 64 bits.
LIMIT = 1 << 24
SPLITS = 4
# Relative widening of distances; doubles are off by less than 1e-15.
SLACK = 1e-12
# Vectors of a batch that are searched together.
TOGETHER = 4096


@dataclass
class Node:
    """Split points (entry numbers), the subtree of each, and per split point and subtree the
    lowest and highest distance to what is in it, its own split point included."""

    splits: list[int]
    children: list[Node | None] = field(default_factory=list)
    low: np.ndarray | None = None
    high: np.ndarray | None = None


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = a - b
    return (d * d).sum(-1)


def build(entries: np.ndarray, own: list[int] | None = None, splits: int = SPLITS) -> Node:
    """A GNAT over the entries with the numbers ``own``.

    The first split point is the lowest number, each further one the entry furthest from
    those chosen, so equal entries give split points only when nothing else is left.
    """
    own = list(range(len(entries))) if own is None else own
    chosen = [own[0]]
    nearest = _squared(entries[own], entries[own[0]])
    while len(chosen) < min(splits, len(own)):
        nearest[[own.index(c) for c in chosen]] = -1
        chosen.append(own[int(nearest.argmax())])
        nearest = np.minimum(nearest, _squared(entries[own], entries[chosen[-1]]))
    rest = [i for i in own if i not in set(chosen)]
    below: list[list[int]] = [[] for _ in chosen]
    for i in rest:
        below[int(_squared(entries[chosen], entries[i]).argmin())].append(i)
    node = Node(chosen, [build(entries, b, splits) if b else None for b in below])
    node.low, node.high = (np.zeros((len(chosen), len(chosen))) for _ in range(2))
    for i, p in enumerate(chosen):
        for j, b in enumerate(below):
            d = np.sqrt(_squared(entries[[chosen[j], *b]], entries[p]).astype(float))
            node.low[i, j], node.high[i, j] = d.min() * (1 - SLACK), d.max() * (1 + SLACK)
    return node


class Search:
    """Nearest entries of many queries at once."""

    def __init__(self, entries: np.ndarray, splits: int = SPLITS):
        self.entries, self.root = entries, build(entries, splits=splits)
        self.measured = 0  # distances between a query and an entry

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per row the number of its nearest entry (of equally near ones the lowest) and the
        squared distance."""
        best = np.full(len(queries), np.iinfo(np.int64).max)
        which = np.zeros(len(queries), np.int64)
        self._enter(self.root, queries, np.arange(len(queries)), best, which)
        return which, best

    def _enter(self, node, queries, own, best, which):
        open_ = np.ones((len(own), len(node.splits)), bool)
        for i, p in enumerate(node.splits):
            # A split point is measured if its own subtree is still in question.
            asked = np.flatnonzero(open_[:, i])
            if not len(asked):
                continue
            rows = own[asked]
            squared = _squared(queries[rows], self.entries[p])
            self.measured += len(rows)
            nearer = (squared < best[rows]) | ((squared == best[rows]) & (p < which[rows]))
            best[rows[nearer]], which[rows[nearer]] = squared[nearer], p
            d = np.sqrt(squared.astype(float))
            reach = np.sqrt(best[rows].astype(float)) * (1 + SLACK)
            near, far = d * (1 - SLACK) - reach, d * (1 + SLACK) + reach
            out = (node.high[i][None, :] < near[:, None]) | (node.low[i][None, :] > far[:, None])
            open_[asked] &= ~out
        for j, child in enumerate(node.children):
            if child is not None:
                rows = own[open_[:, j]]
                if len(rows):
                    self._enter(child, queries, rows, best, which)


def usable(column: pa.Array, dim: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Rows whose vector (of ``dim`` components, if given) has only finite ones, and their
    integers."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    wanted = np.flatnonzero((sizes == dim) if dim is not None else (sizes >= 0))
    picked = column.take(pa.array(wanted))
    values = pc.fill_null(picked.flatten().cast(pa.float64()), np.nan).to_numpy(zero_copy_only=False)
    rows = np.repeat(np.arange(len(wanted)), sizes[wanted])
    bad = np.zeros(len(wanted), bool)
    bad[rows[~np.isfinite(values)]] = True
    kept = values if not bad.any() else values[~bad[rows]]
    whole = np.clip(np.floor(SCALE * kept), -LIMIT, LIMIT).astype(np.int64)
    return wanted[~bad], whole


@dataclass
class Codebooks:
    """Entries of every part position: parts x entries x components."""

    entries: np.ndarray
    dim: int

    def cut(self, whole: np.ndarray, n: int) -> np.ndarray:
        """``n`` rows x parts x components; a dimension that parts do not divide gets zeros at the end."""
        rows = whole.reshape(n, self.dim)
        parts, _, width = self.entries.shape
        return np.pad(rows, ((0, 0), (0, parts * width - self.dim))).reshape(n, parts, width)

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.reshape(-1).tolist())).encode()).hexdigest()

    def searches(self) -> list[Search]:
        return [Search(e) for e in self.entries]


def _assigned(batches, books: Codebooks) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of rows with the rows that have a code, their parts, entry numbers and distances."""
    searches = books.searches()
    for whole in batches:
        for start in range(0, whole.num_rows, TOGETHER):
            batch = whole.slice(start, TOGETHER)
            rows, values = usable(batch["embedding"], books.dim)
            cut = books.cut(values, len(rows))
            found = [s.nearest(cut[:, k]) for k, s in enumerate(searches)]
            yield batch, rows, cut, np.stack([f[0] for f in found], 1), np.stack([f[1] for f in found], 1)


def first_entries(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> Codebooks | None:
    """Codebooks from the vectors of the smallest ids; ``None`` if there are none.

    The smallest id's vector gives the dimension; ids whose vectors all have another one give
    no entry, nor do null ids. An id that is repeated counts once, with its smallest vector.
    """
    v = F.col("embedding").cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    known = vectors.select("vec_id", v.alias("embedding")).where(F.col("vec_id").isNotNull() & v.isNotNull() & fine)

    def smallest(rows: DataFrame, n: int) -> list:
        """Ids alone; repeated ones make another look at what comes after them necessary."""
        ids: list = []
        while len(ids) < n:
            later = rows.where(F.col("vec_id") > F.lit(ids[-1])) if ids else rows
            found = [r["vec_id"] for r in later.select("vec_id").orderBy("vec_id").limit(n).collect()]
            ids = sorted({*ids, *found})[:n]
            if len(found) < n:
                break
        return ids

    def vectors_of(rows: DataFrame, ids: list) -> list:
        picked = rows.where(F.col("vec_id").isin(ids)).groupBy("vec_id").agg(F.min("embedding").alias("v"))
        return [r["v"] for r in picked.orderBy("vec_id").collect()]

    first = smallest(known, 1)
    if not first:
        return None
    dim = len(vectors_of(known, first)[0])
    alike = known.where(F.size("embedding") == dim)
    seeds = vectors_of(alike, smallest(alike, entries))
    books = Codebooks(np.zeros((parts, len(seeds), max(1, -(-dim // parts))), np.int64), dim)
    _, whole = usable(pa.array(seeds, pa.list_(pa.float64())), dim)
    return Codebooks(np.ascontiguousarray(books.cut(whole, len(seeds)).transpose(1, 0, 2)), dim)


def train(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks | None:
    """Codebooks after rounds of assignment and integer means over all vectors.

    A task adds up the parts of every entry, so a round moves a few numbers per task; sums
    and counts of the entries are all that reaches the driver.
    """
    books = first_entries(vectors, parts, entries)
    for _ in range(rounds if books is not None else 0):
        sent = vectors.sparkSession.sparkContext.broadcast(books)

        def sums(batches, sent=sent):
            books = sent.value
            n_parts, n_entries, width = books.entries.shape
            total = np.zeros((n_parts, n_entries, width), object)
            count = np.zeros((n_parts, n_entries), np.int64)
            for _, _, cut, which, _ in _assigned(batches, books):
                for k in range(n_parts):
                    now = np.zeros((n_entries, width), np.int64)
                    np.add.at(now, which[:, k], cut[:, k])
                    total[k] += now
                    count[k] += np.bincount(which[:, k], minlength=n_entries)
            part, entry, place = np.indices(total.shape).reshape(3, -1)
            used = count[part, entry] > 0
            part, entry, place = part[used], entry[used], place[used]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(place.astype(np.int32)),
                    pa.array([str(x) for x in total[part, entry, place]], pa.string()), pa.array(count[part, entry]),
                ],
                ["part", "entry", "place", "total", "n"],
            )

        found = vectors.select("embedding").mapInArrow(sums, "part int, entry int, place int, total string, n long")
        found = found.groupBy("part", "entry", "place").agg(
            F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")
        )
        new = books.entries.copy()
        for r in found.collect():
            new[r["part"], r["entry"], r["place"]] = int(r["total"]) // r["n"]
        sent.unpersist()
        books = Codebooks(new, books.dim)
    return books


def encode(vectors: DataFrame, books: Codebooks | None) -> DataFrame:
    """(vec_id, label, codes array<int>, error) of every row with a usable vector.

    A usable vector is not null and holds no null or non-finite component; other rows are
    left out. One whose dimension is not the codebooks' has null codes and error. Repeated
    rows all stay; an id or label may be null; other columns are not read.
    """
    sent = vectors.sparkSession.sparkContext.broadcast(books)

    def apply(batches):
        books = sent.value
        if books is None:
            return
        for batch, rows, _, which, squared in _assigned(batches, books):
            kept, _ = usable(batch["embedding"])
            place = np.searchsorted(kept, rows)
            coded = np.zeros(len(kept), bool)
            coded[place] = True
            codes = np.zeros((len(kept), which.shape[1]), np.int32)
            codes[place] = which
            error = np.zeros(len(kept), np.int64)
            error[place] = squared.sum(1)
            cuts = pa.array(np.arange(len(kept) + 1, dtype=np.int32) * which.shape[1])
            lists = pa.ListArray.from_arrays(cuts, pa.array(codes.reshape(-1)), mask=pa.array(~coded))
            own = pa.array(kept)
            yield pa.RecordBatch.from_arrays(
                [batch["vec_id"].take(own), batch["label"].take(own), lists, pa.array(error, mask=~coded)],
                ["vec_id", "label", "codes", "error"],
            )

    schema = f"vec_id {_type(vectors, 'vec_id')}, label {_type(vectors, 'label')}, codes array<int>, error long"
    return vectors.select("vec_id", "label", "embedding").mapInArrow(apply, schema)


def decode(encoded: DataFrame, books: Codebooks) -> DataFrame:
    """``encoded`` with ``whole`` array<long>: the integer vector that the codes stand for."""
    sent = encoded.sparkSession.sparkContext.broadcast(books)

    def apply(batches):
        books = sent.value
        for batch in batches:
            codes = [c and books.entries[np.arange(len(c)), c].reshape(-1)[: books.dim].tolist() for c in batch["codes"].to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(codes, pa.list_(pa.int64()))], [*batch.schema.names, "whole"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(apply, f"{fields}, whole array<long>")


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of every usable vector.

    ``code`` has two hex digits per part. ``label_error`` adds up the errors of equal labels,
    nulls together; it is null where all of them are. Components beyond ``LIMIT`` / ``SCALE``
    (4,096) are cut there. See :func:`encode` for what is left out. An empty table, or one
    without a usable vector and id, gives an empty table.
    """
    books = train(vectors, parts, entries, rounds)
    coded = stored(encode(vectors, books), "vector-codes")
    # Written, so that its size is known: Spark broadcasts it if it is small.
    labels = stored(coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error")), "label-errors")
    code = F.array_join(F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    digest = books.sha256() if books is not None else ""
    return coded.join(labels, F.col("label").eqNullSafe(F.col("_label"))).select(
        "vec_id", code.alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )
