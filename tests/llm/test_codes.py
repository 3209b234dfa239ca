"""Vector codes against a slow version; trees against brute force."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from recordlake.llm import codes

VECTORS = "vec_id long, embedding array<double>, label int"


def slow(rows, parts=8, entries=16, rounds=6):
    """The contract, step by step, in Python integers."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    whole = [[math.floor(4096 * x) for x in r[1]] for r in kept]
    first = {}
    for r, w in sorted(zip(kept, whole), key=lambda p: (p[0][0] is None, p[0][0] or 0, p[0][1])):
        if r[0] is not None:
            first.setdefault(r[0], w)
    dim = len(next(iter(first.values())))
    width = -(-dim // parts)
    cut = lambda w: [(w + [0] * (parts * width - dim))[k * width : (k + 1) * width] for k in range(parts)]
    pieces = [cut(w) for w in whole]
    seeds = [cut(first[i]) for i in sorted(first)[:entries]]
    books = [[s[k] for s in seeds] for k in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda p, book: min(range(len(book)), key=lambda e: (far(p, book[e]), e))
    for _ in range(rounds):
        for k in range(parts):
            which = [nearest(p[k], books[k]) for p in pieces]
            for e in range(len(seeds)):
                own = [p[k] for p, w in zip(pieces, which) if w == e]
                if own:
                    books[k][e] = [sum(c) // len(own) for c in zip(*own)]
    out, per_label = [], {}
    for r, p in zip(kept, pieces):
        best = [nearest(p[k], books[k]) for k in range(parts)]
        error = sum(far(p[k], books[k][best[k]]) for k in range(parts))
        out.append((r[0], "".join(f"{b:02x}" for b in best), error, r[2]))
        per_label[r[2]] = per_label.get(r[2], 0) + error
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((i, c, e, per_label[label], digest) for i, c, e, label in out), key=str)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def vectors(n=400, dim=16, seed=0):
    rng = np.random.default_rng(seed)
    rows = [(int(i), rng.normal(0, 0.1 + 0.3 * (i % 3), dim).tolist(), [1, 2, None][i % 3]) for i in rng.permutation(n)]
    # Ties: few distinct values, copies, zeros.
    rows += [(n + i, [0.25 * (i % 2)] * dim, 3) for i in range(40)]
    return rows


def test_codes_equal_the_slow_version(spark):
    rows = vectors()
    df = spark.createDataFrame(rows, VECTORS).repartition(5).withColumns({c: F.lit("x") for c in ("code", "error", "_label", "part")})
    assert result(codes.compress(df)) == slow(rows)


def test_odd_rows(spark):
    rows = vectors(60, 10, 1) + [
        (-5, None, 1), (-4, [1.0, None] * 5, 1), (-3, [float("nan")] * 10, 1), (-2, [float("inf")] * 10, 2),
        (3, [0.5] * 10, None), (3, [0.5] * 10, None), (None, [0.1] * 10, 1), (None, [0.1] * 10, 1),
    ]
    df = spark.createDataFrame(rows, VECTORS)
    assert result(codes.compress(df)) == slow(rows)
    # Another dimension: no code; very large components: cut.
    more = spark.createDataFrame([(900, [1.0] * 3, 7), (901, [], 7), (902, [1e300] * 10, 8)], VECTORS)
    found = {r.vec_id: r for r in codes.compress(df.union(more)).collect()}
    assert found[900].code is found[900].error is found[900].label_error is found[901].code is None
    assert len(found[902].code) == 16 and found[902].error == found[902].label_error


def test_few_empty_and_useless_tables(spark):
    three = [(i, [float(i)] * 8, None) for i in range(3)]
    assert result(codes.compress(spark.createDataFrame(three, VECTORS))) == slow(three)
    for rows in ([], [(1, None, 1)], [(None, [1.0] * 8, 1)]):
        assert codes.compress(spark.createDataFrame(rows, VECTORS)).collect() == []
    assert [r.error for r in codes.compress(spark.createDataFrame([(1, [], 1)], VECTORS)).collect()] == [0]
    floats = spark.createDataFrame(three, "vec_id int, embedding array<float>, label string")
    assert result(codes.compress(floats)) == slow(three)


def test_codes_stand_for_near_vectors(spark):
    df = spark.createDataFrame(vectors(), VECTORS)
    books = codes.train(df)
    for r in codes.decode(codes.encode(df, books).join(df.select("vec_id", "embedding"), "vec_id"), books).limit(50).collect():
        far = sum((math.floor(4096 * x) - y) ** 2 for x, y in zip(r.embedding, r.whole))
        assert far == r.error


@pytest.mark.parametrize("width,spread", [(2, 3), (8, 200), (4, 1 << 24)])
@pytest.mark.parametrize("splits", [1, 2, 4, 7])
def test_trees_find_what_brute_force_finds(width, spread, splits):
    rng = np.random.default_rng(width + splits)
    for n in (1, 2, 5, 16, 200):
        entries = rng.integers(-spread, spread + 1, (n, width))
        entries[n // 2 :] = entries[rng.integers(0, n, n - n // 2)]  # equal entries
        queries = np.concatenate([rng.integers(-spread, spread + 1, (300, width)), entries])
        squared = ((queries[:, None] - entries[None]) ** 2).sum(2)
        which, best = codes.Search(entries, splits).nearest(queries)
        assert (which == squared.argmin(1)).all() and (best == squared.min(1)).all()


def test_trees_leave_subtrees_out():
    rng = np.random.default_rng(3)
    centres = rng.integers(-10000, 10000, (40, 8))
    entries = np.concatenate([c + rng.integers(-50, 50, (25, 8)) for c in centres])
    search = codes.Search(entries)
    search.nearest(centres)
    assert search.measured < 0.2 * len(centres) * len(entries)
