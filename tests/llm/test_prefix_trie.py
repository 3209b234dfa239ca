"""The prefix trie against a slow version; balanced parentheses against a stack."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from recordlake.llm import prefix_trie
from recordlake.llm.parens import Parens

TURNS = "conv_id long, turn long, role string, text string"


def slow(rows):
    """The contract over dictionaries of whole prefixes."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    members = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        path = own.get(c - int(np.fmod(c, 100)), [])[:h] + ts[h:]
        for d in range(len(path) + 1):
            members.setdefault(tuple(path[:d]), []).append((c, d == len(path)))
    kids = {}
    for node in members:
        if node:
            kids.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[k] for k in kids.get(node, [])) or 1
        text = len(node[-1][1]) if node else 0
        saved[node] = (len(members[node]) - 1) * text + sum(saved[k] for k in kids.get(node, []))
    smallest = {node: min(c for c, _ in m) for node, m in members.items()}
    return sorted(
        (
            smallest[node], len(node), smallest[node[:-1]] if node else None, len(m), len(kids.get(node, [])), leaves[node],
            saved[node], hashlib.sha256(",".join(str(c) for c in sorted(c for c, end in m if end)).encode()).hexdigest(),
        )
        for node, m in members.items()
    )


def result(df):
    return sorted(tuple(r) for r in df.collect())


def conversations(seed, n=150):
    """Few texts, so paths share a lot; some conversations hold nothing but what others do."""
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-150, 700), n):
        for t in range(rng.choice([1, 1, 2, 3, 6, 9])):
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice(["a", "bb", "é😀", ""])))
    return rows


ODD = [
    (None, 0, "user", "no id"), (7, None, None, None), (7, None, None, None), (7, 3, "user", "x"), (7, 3, "user", "x"),
    (7, 3, "assistant", "x"), (8, 1, "", "user"), (9, 1, "user", ""), (100, 1, "u", "w" * 300000),
]


def test_trie_equals_the_slow_version(spark):
    rows = conversations(1) + ODD
    df = spark.createDataFrame(rows, TURNS).repartition(5)
    df = df.withColumns({c: F.lit("x") for c in ("key", "path", "depth", "n", "_base")})
    found = prefix_trie.prefix_trie(df)
    assert found.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert result(found) == slow(rows)


@pytest.mark.parametrize("most", [1, 4, 60])
def test_many_shards_merge(spark, most, monkeypatch):
    monkeypatch.setattr(prefix_trie, "RANGE_TURNS", 2)
    rows = conversations(most, 120) + [(c, t, "user", "same") for c in range(3000, 3040) for t in range(7)]
    turns = spark.createDataFrame(rows, TURNS).repartition(3)
    assert result(prefix_trie.nodes(prefix_trie.rebuilt(turns), most)) == slow(rows)


def test_one_long_conversation_and_one_hot_one(spark):
    rng = random.Random(2)
    rows = [(5, t, "user", str(t % 7)) for t in range(5000)]
    rows += [(205, t, "user", str(t % 7)) for t in range(4000)]
    rows += [(1000 + c, 0, "user", "copy") for c in range(800)]
    rng.shuffle(rows)
    assert result(prefix_trie.prefix_trie(spark.createDataFrame(rows, TURNS))) == slow(rows)


def test_empty_tables(spark):
    assert prefix_trie.prefix_trie(spark.createDataFrame([], TURNS)).collect() == []
    assert prefix_trie.prefix_trie(spark.createDataFrame([(None, 1, "a", "b")], TURNS)).collect() == []
    # A conversation whose only turns are replaced by those of one that is not there.
    gone = next(c for c in range(301, 400) if zlib.crc32(str(c).encode()) % 6 > 1)
    rows = [(gone, 1, "user", "hello")]
    assert result(prefix_trie.prefix_trie(spark.createDataFrame(rows, TURNS))) == slow(rows)


@pytest.mark.parametrize("n,down", [(1, 0.5), (40, 0.5), (3000, 0.5), (5000, 0.9), (5000, 0.1)])
def test_parentheses(n, down):
    rng, bits, stack, closes, leaves = random.Random(n), [], [], {}, 0
    left = n
    while left or stack:
        if left and (not stack or rng.random() < down):
            stack.append(len(bits))
            bits.append(True)
            left -= 1
        else:
            closes[stack.pop()] = len(bits)
            bits.append(False)
    tree = Parens(np.array(bits))
    assert dict(zip(tree.opens.tolist(), tree.closes().tolist())) == closes
    rank = tree.leaf_rank()
    leaves = [i for i in range(len(bits) - 1) if bits[i] and not bits[i + 1]]
    assert all(rank[i] == sum(x < i for x in leaves) for i in range(0, len(bits) + 1, 97))
