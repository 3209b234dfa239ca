"""The prefix trie of conversations, as balanced parentheses per shard.

A conversation becomes a path: 16 bytes per turn, a digest of role and text. Distinct paths,
with the number of conversations that end there and the smallest of them, are sorted. Sorted
paths are a walk through the trie in preorder; a shard is a run of them and writes its part of
the walk as balanced parentheses. A node's subtree lies between its parenthesis and the one
that closes it (found through blocks of smallest excess), its leaves are a difference of ranks
of ``()`` pairs, and conversations and savings are differences of cumulative arrays.

The path from the root to where a shard begins was opened by an earlier shard. Such shared
spines are opened again, but what must count once (a node's own text, a leaf, a child) counts
in the first shard alone, so that the shards' numbers of a spine node simply add up. Only
spine nodes are merged by a shuffle; all others are final where they were found.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlake.llm.parens import Parens
from recordlake.llm.store import small, stored
from recordlake.session import pin

TURN = 16  # bytes per turn in a path
SIZE = 4  # and in its sizes
# Turns of a path that decide which shard range it is in.
RANGE_TURNS = 16
# A shard is closed when it has as many nodes.
SHARD_NODES = 1 << 16
NO_END = hashlib.sha256(b"").hexdigest()
ROOT = bytes(TURN)


def _digest(*parts: bytes) -> bytes:
    return hashlib.blake2b(b"".join(parts), digest_size=TURN).digest()


def paths(turns: DataFrame) -> DataFrame:
    """(conv_id, path, sizes): digests and code points of a conversation's turns in order.

    Turns are in the order of turn (null first), then role, then text; null roles and texts
    are empty; repeated rows are turns of their own; rows without a conv_id take no part. A
    conversation is read in one task as a stream and leaves 20 bytes per turn.
    """
    rows = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def read(batches):
        now, path, sizes = None, bytearray(), bytearray()

        def closed(done):
            ids, found, lengths = zip(*done)
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(found, pa.binary()), pa.array(lengths, pa.binary())],
                ["conv_id", "path", "sizes"],
            )

        for batch in batches:
            done = []
            for conv, role, text in zip(*(batch[c].to_pylist() for c in ("conv_id", "role", "text"))):
                if conv != now:
                    if now is not None:
                        done.append((now, bytes(path), bytes(sizes)))
                    now, path, sizes = conv, bytearray(), bytearray()
                who = role.encode("utf-8")
                path += _digest(len(who).to_bytes(8, "little"), who, text.encode("utf-8"))
                sizes += len(text).to_bytes(SIZE, "little")
            if done:
                yield closed(done)
        if now is not None:
            yield closed([(now, bytes(path), bytes(sizes))])

    return ordered.select("conv_id", "role", "text").mapInArrow(read, "conv_id long, path binary, sizes binary")


def rebuilt(turns: DataFrame, every: int = 100, most: int = 6) -> DataFrame:
    """(conv_id, key, path, sizes): conversations that begin like the one before them that
    ``every`` divides.

    The first h turns come from conversation c - c % every, h being crc32 of the decimal c
    modulo ``most``; c's own turns after its first h follow.
    """
    own = stored(paths(turns), "conversation-paths")
    heads = own.where(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("_base"), F.substring("path", 1, TURN * (most - 1)).alias("_path"),
        F.substring("sizes", 1, SIZE * (most - 1)).alias("_sizes"),
    )
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    based = own.withColumn("_h", h).withColumn("_from", F.col("conv_id") - F.col("conv_id") % every)
    joined = based.join(heads, F.col("_from") == F.col("_base"), "left")

    def both(head: str, tail: str, width: int):
        first = F.coalesce(F.substring(F.col(head), F.lit(1), width * F.col("_h")), F.lit(b""))
        rest = F.substring(F.col(tail), width * F.col("_h") + 1, F.lit(2**31 - 1))
        return F.concat(first, rest).alias(tail)

    done = joined.select("conv_id", both("_path", "path", TURN), both("_sizes", "sizes", SIZE))
    return done.select("conv_id", F.unhex(F.sha2("path", 256)).alias("key"), "path", "sizes")


def end_digests(ends: DataFrame) -> DataFrame:
    """(key, ends_sha256): hex digest of each key's conversations in order, comma-joined.

    Ranges of (key, conv_id) are written as text by many tasks; only hashing, which is a
    sequence, takes one task per key, over pieces of that text.
    """
    ordered = ends.select("key", "conv_id").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")

    def write(batches):
        for batch in batches:
            keys, ids = batch["key"].to_pylist(), batch["conv_id"].to_pylist()
            cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
            if len(keys):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([keys[a] for a in cuts[:-1]], pa.binary()), pa.array([ids[a] for a in cuts[:-1]], pa.int64()),
                        pa.array([",".join(map(str, ids[a:b])) for a, b in zip(cuts, cuts[1:])], pa.string()),
                    ],
                    ["key", "first", "ids"],
                )

    def read(batches):
        now, state = None, None
        for batch in batches:
            done = []
            for key, ids in zip(batch["key"].to_pylist(), batch["ids"].to_pylist()):
                if key != now:
                    if now is not None:
                        done.append((now, state.hexdigest()))
                    now, state = key, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if done:
                yield _ended(done)
        if now is not None:
            yield _ended([(now, state.hexdigest())])

    def _ended(done):
        keys, digests = zip(*done)
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(digests, pa.string())], ["key", "ends_sha256"])

    written = ordered.mapInArrow(write, "key binary, first long, ids string")
    pieces = written.repartition("key").sortWithinPartitions("key", "first")
    return pieces.select("key", "ids").mapInArrow(read, "key binary, ends_sha256 string")


def shared_turns(a: bytes, b: bytes) -> int:
    """Turns with which both paths begin."""
    n = min(len(a), len(b)) // TURN
    same = (np.frombuffer(a, "<u8", 2 * n) == np.frombuffer(b, "<u8", 2 * n)).reshape(n, 2).all(1)
    return n if same.all() else int(same.argmin())


class Shard:
    """A run of sorted paths as parentheses, and the nodes in the order in which they open."""

    def __init__(self, again: int):
        """``again`` is the depth down to which the first path was opened by an earlier shard;
        -1 if there is none."""
        self.again = again
        self.bits = bytearray(b"\x01")
        self.depth, self.parent, self.size, self.key = [0], [0], [0], [ROOT]
        self.ends, self.lowest, self.digest = [0], [None], [None]
        self.stack, self.last = [0], b""

    def add(self, path: bytes, sizes: bytes, n: int, conv: int, digest: str) -> None:
        same = shared_turns(self.last, path)
        self.bits += b"\x00" * (len(self.stack) - 1 - same)
        del self.stack[same + 1 :]
        lengths = np.frombuffer(sizes, "<u4")
        for d in range(same, len(path) // TURN):
            top = self.stack[-1]
            self.stack.append(len(self.depth))
            self.depth.append(d + 1)
            self.parent.append(top)
            self.size.append(int(lengths[d]))
            self.key.append(_digest(self.key[top], path[d * TURN : (d + 1) * TURN]))
            self.ends.append(0)
            self.lowest.append(None)
            self.digest.append(None)
        self.bits += b"\x01" * (len(path) // TURN - same)
        node = self.stack[-1]
        self.ends[node], self.lowest[node], self.digest[node], self.last = n, conv, digest, path

    def rows(self, shared: int, extended: bool) -> pa.RecordBatch:
        """The shard's numbers per node. ``shared`` is the depth down to which the last path is
        opened again by the next shard (-1: there is none), and ``extended`` says whether that
        one goes on from the end of the last path."""
        bits = np.frombuffer(bytes(self.bits + b"\x00" * len(self.stack)), bool)
        tree, n = Parens(bits), len(self.depth)
        closes = tree.closes()
        first = np.arange(n)
        stop = first + (closes - tree.opens + 1) // 2
        depth, parent = np.array(self.depth), np.array(self.parent)

        def within(values):
            total = np.concatenate([[0], np.cumsum(values)])
            return total[stop] - total[first]

        # Depth and preorder agree on the first path, which begins at the root.
        owned = ~((first == depth) & (depth <= self.again))
        convs = within(np.array(self.ends, np.int64))
        rank = tree.leaf_rank()
        leaves = rank[closes] - rank[tree.opens]
        spine = np.zeros(n, bool)
        spine[self.stack] = True
        if extended:
            leaves[spine] -= 1
        size = np.array(self.size, np.int64)
        saved = within(size * (convs - owned))
        children = np.bincount(parent[1:][owned[1:]], minlength=n)
        lowest = self.lowest
        for i in range(n - 1, 0, -1):
            own, above = lowest[i], self.parent[i]
            if lowest[above] is None or own < lowest[above]:
                lowest[above] = own
        both = ~owned | (spine & (depth <= shared))
        lowest = np.array(lowest, np.int64)
        known = ~both[parent]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(self.key, pa.binary()), pa.array([self.key[p] for p in self.parent], pa.binary()),
                pa.array(depth), pa.array(both), pa.array(lowest), pa.array(lowest[parent], mask=~known),
                pa.array(convs), pa.array(children), pa.array(leaves), pa.array(saved), pa.array(self.digest, pa.string()),
            ],
            NAMES,
        )


NAMES = [
    "key", "parent_key", "depth", "shared", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves",
    "saved_tokens", "ends_sha256",
]
_SCHEMA = (
    "key binary, parent_key binary, depth long, shared boolean, conv_id long, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
)


def shards(rows: Iterator[tuple], before: bytes | None, after: bytes | None, most: int = SHARD_NODES) -> Iterator[pa.RecordBatch]:
    """Node rows of sorted (path, sizes, n, conv, digest), a shard at a time.

    ``before`` and ``after`` are the beginnings of the paths next to these; ``None`` if there
    are none. Memory holds one shard.
    """
    shard, full = None, False
    for row in rows:
        path = row[0]
        if full:
            yield shard.rows(shared_turns(shard.last, path), path.startswith(shard.last))
            shard, before = None, shard.last
        if shard is None:
            shard = Shard(-1 if before is None else shared_turns(before, path))
        shard.add(*row)
        full = len(shard.depth) >= most
    if shard is not None:
        shared = -1 if after is None else shared_turns(shard.last, after)
        yield shard.rows(shared, after is not None and after.startswith(shard.last))


def nodes(conversations: DataFrame, most: int = SHARD_NODES) -> DataFrame:
    """Nodes of the trie of (conv_id, key, path, sizes), as :func:`rebuilt` gives them.

    Per node: conv_id (smallest member), depth, parent_conv_id (null at the root), n_convs,
    n_children, n_leaves and saved_tokens (over the subtree), ends_sha256. An empty table has
    no nodes.
    """
    distinct = conversations.groupBy("key", "path", "sizes").agg(F.count("*").alias("n"), F.min("conv_id").alias("conv"))
    ended = distinct.join(end_digests(conversations), "key")
    start = F.substring("path", 1, RANGE_TURNS * TURN)
    walk = pin(
        ended.select("path", "sizes", "n", "conv", "ends_sha256").repartitionByRange(start).sortWithinPartitions("path")
    )

    def borders(batches):
        first = last = None
        for batch in batches:
            if batch.num_rows:
                first = batch["path"][0].as_py() if first is None else first
                last = batch["path"][batch.num_rows - 1].as_py()
        if first is not None:
            cut = RANGE_TURNS * TURN
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()]), pa.array([first[:cut]], pa.binary()), pa.array([last[:cut]], pa.binary())],
                ["part", "first", "last"],
            )

    # A row per range; paths of different ranges differ in their first turns.
    found = sorted(walk.select("path").mapInArrow(borders, "part long, first binary, last binary").collect())
    before = {b["part"]: bytes(a["last"]) for a, b in zip(found, found[1:])}
    after = {a["part"]: bytes(b["first"]) for a, b in zip(found, found[1:])}
    sent = conversations.sparkSession.sparkContext.broadcast((before, after))

    def build(batches):
        part = TaskContext.get().partitionId()
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        yield from shards(rows, sent.value[0].get(part), sent.value[1].get(part), most)

    # A node that some shards share has its conversations in all of them.
    every = stored(walk.mapInArrow(build, _SCHEMA), "trie-shards")
    spine = stored(
        every.where("shared").groupBy("key", "parent_key", "depth").agg(
            F.min("conv_id").alias("conv_id"),
            *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
            F.max("ends_sha256").alias("ends_sha256"),
        ),
        "trie-spine",
    )
    above = small(spine.select(F.col("key").alias("_above"), F.col("conv_id").alias("parent_conv_id")))
    final = every.where("NOT shared AND parent_conv_id IS NOT NULL")
    open_ = every.where("NOT shared AND parent_conv_id IS NULL").drop("shared", "parent_conv_id").unionByName(spine)
    # The root is its own parent in the shards.
    open_ = open_.withColumn("parent_key", F.when(F.col("depth") > 0, F.col("parent_key")))
    named = open_.join(above, F.col("parent_key") == F.col("_above"), "left")
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    digest = F.coalesce("ends_sha256", F.lit(NO_END)).alias("ends_sha256")
    root = F.when(F.col("depth") > 0, F.col("parent_conv_id")).alias("parent_conv_id")
    columns = [root if c == "parent_conv_id" else F.col(c) for c in out]
    return final.select(*columns, digest).unionByName(named.select(*columns, digest))


def prefix_trie(turns: DataFrame) -> DataFrame:
    """The trie of rebuilt conversations; see :func:`rebuilt` and :func:`nodes`.

    ``turns`` has conv_id (a whole number), turn, role and text; other columns are not read.
    """
    return nodes(stored(rebuilt(turns), "rebuilt-conversations"))
