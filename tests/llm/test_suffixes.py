"""Suffix-array dedup against a brute-force version."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from recordlake.llm import bytesets, suffixes

SCHEMA = "doc_id long, text string"


def brute(rows, length=100):
    """What every row keeps, judged window by window over the rows in order."""
    seen, out = set(), []
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for s in range(len(raw) - length + 1):
            window = raw[s : s + length]
            if window in seen:
                gone[s : s + length] = b"\x01" * length
            seen.add(window)
        runs = sum(1 for k in range(len(gone)) if gone[k] and (k == 0 or not gone[k - 1]))
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((i, len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def in_order(rows):
    return sorted(tuple(r) for r in rows if r[0] is not None), sorted(tuple(r)[1:] for r in rows if r[0] is None)


def make(seed):
    rng = random.Random(seed)
    word = lambda n: " ".join(rng.choice(["der", "ou", "éa", "thion", "日", "x", "\n"]) for _ in range(n))
    shared = [word(rng.randint(30, 90)) for _ in range(6)]
    rows = [(i, "".join(rng.choice([word(rng.randint(1, 50)), rng.choice(shared), rng.choice(shared)[5:-7]]) for _ in range(rng.randint(1, 5))))
            for i in rng.sample(range(1000), 60)]
    rows += [(2000 + k, shared[0] + c) for k, c in enumerate("abcdefghij")]
    rows += [(3000, "ab" * 400), (3001, "ab" * 300 + "c"), (3002, None), (3003, ""), (None, shared[1] * 2), (3004, "z" * 99)]
    rows += [(3005, shared[2] * 2), (3005, shared[2] * 2), (3005, "q" + shared[2])]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_removal_like_brute_force(spark, seed):
    rows = make(seed)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(7).withColumn("id", F.lit(1)).withColumn("records", F.lit("x"))
    assert in_order(suffixes.removal_digests(docs).collect()) == in_order(brute(rows))


def test_many_collections_and_hot_anchors(spark, monkeypatch):
    """Small bounds: several shards, collections, flushes, and anchors dealt out by window."""
    rows = [r for r in make(3) if r[0] is not None and r[0] != 3005]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    keyed = suffixes.keyed(docs)
    found = suffixes.repeated_anchors(keyed, 5, 100, 32)
    for limit in (2, 6, 10**9):
        hot = suffixes.hot_anchors(found, limit)
        assert (limit < 10**9) == bool(hot)
        spans = suffixes.repeated_spans(keyed, found, 9, 100, 32, hot)
        per = {}
        for r in spans.collect():
            per.setdefault(r["id"], []).append(r["records"])
        got = [(i, suffixes._cut((t or "").encode(), per.get(i))) for i, t in rows]
        want = {r[0]: r for r in brute(rows)}
        for i, (kept, removed, runs) in got:
            assert (removed, runs, hashlib.sha256(kept).hexdigest()) == want[i][2:]


def test_long_text_in_segments(monkeypatch):
    monkeypatch.setattr(suffixes, "SEGMENT", 500)
    data = np.frombuffer(random.Random(4).randbytes(3000).replace(b"\0", b"a"), np.uint8)
    cut = suffixes.anchors(data, np.array([0, len(data)]))
    monkeypatch.setattr(suffixes, "SEGMENT", 1 << 20)
    whole = suffixes.anchors(data, np.array([0, len(data)]))
    spread = lambda a: [(f + k, f + b, h) for _, f, m, b, h in zip(*a) for k in range(m + 1)]
    assert spread(cut) == spread(whole)


def test_transform_and_common_prefixes():
    """The order built column by column is the order of the sorted suffixes."""
    texts = [b"banana", b"bandan", b"banana"]
    matrix = np.array([list(t) for t in texts], np.uint8).T
    repeated = suffixes.suffix_repeats(lambda j: matrix[j], 3, np.zeros(3, int), np.full(3, 6), 3, 6)
    assert repeated.tolist() == [[False] * 4, [True, False, False, False], [True] * 4]


def test_nothing_and_clean_texts(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert suffixes.removal_digests(empty).collect() == []
    once = "".join(chr(0xE0 + i) for i in range(60))  # 120 bytes
    half = "\u0160" + once[1:55] + "."  # from the second byte of its first letter on as above
    docs = spark.createDataFrame(
        [(1, once, 60), (2, "x" + once, 61), (3, "plain", 5), (4, None, None), (5, once, 60), (6, half, 56)],
        "doc_id long, text string, n_chars long",
    )
    got = {r.doc_id: (r.text, r.n_chars) for r in suffixes.without_repeats(docs).collect()}
    assert got == {1: (once, 60), 2: ("x", 1), 3: ("plain", 5), 4: (None, None), 6: (".", 1)}


def test_chunks_cover_all_rows():
    import pyarrow as pa

    texts = pa.array(["a" * 5, None, "", "b" * 300, "c"])
    assert [(r, e) for r, e, *_ in bytesets.chunks(texts, 10)] == [(0, 3), (3, 4), (4, 5)]
