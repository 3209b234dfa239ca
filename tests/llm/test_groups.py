"""Links and components against brute force."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from recordlake.llm import components, forest, pivots


def slow_components(nodes, links):
    """Smallest reachable node, by repeated passes."""
    low = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            m = min(low[a], low[b])
            changed |= low[a] != m or low[b] != m
            low[a] = low[b] = m
    return low


@pytest.mark.parametrize("seed", [1, 2])
def test_components_of_chains_stars_and_random_links(spark, seed):
    rng = random.Random(seed)
    links = [(100 + i, 101 + i) for i in range(25)] + [(500, 501 + i) for i in range(40)]
    links += [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(35)] + [(7, 7), (3, 2), (2, 3)]
    rng.shuffle(links)
    edges = spark.createDataFrame(links, "u long, v long").repartition(3)
    got = {r.id: r.component for r in components.components(edges).collect()}
    links = [e for e in links if e[0] != e[1]]
    want = slow_components({n for e in links for n in e}, links)
    assert got == {n: c for n, c in want.items()}


def test_components_of_nothing(spark):
    assert components.components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_local_components():
    rng = np.random.default_rng(3)
    for _ in range(30):
        n = int(rng.integers(1, 40))
        a, b = rng.integers(0, n, (2, int(rng.integers(0, 40))))
        low = slow_components(range(n), list(zip(a.tolist(), b.tolist())))
        assert components.local_components(n, a, b).tolist() == [low[i] for i in range(n)]


# --- embeddings ---------------------------------------------------------------------------------

NAN, INF = float("nan"), float("inf")


def vectors(seed):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(40):
        base = rng.normal(size=12)
        for k in range(int(rng.integers(1, 9))):
            noise = rng.normal(size=12) * rng.choice([0, 0.05, 0.12, 0.3])
            rows.append((len(rows), (base + noise).tolist(), int(rng.integers(0, 3)) if i % 4 == 0 else i % 3))
    base = rng.normal(size=12)
    rows += [(1000 + k, (base + rng.normal(size=12) * 0.02).tolist(), 1) for k in range(60)]
    rows += [(2000, None, 1), (2001, [0.0] * 12, 1), (2002, [1.0, None] * 6, 1), (2003, [NAN] * 12, 1), (2004, [INF] * 12, 1),
             (2005, base.tolist(), None), (2006, (base * 1e200).tolist(), 1), (2007, (base * 1e-200).tolist(), 1),
             (2008, [1.0, 2.0], 1), (2009, [2.0, 4.0], 1), (2010, [], 1), (None, base.tolist(), 1), (2011, base.tolist(), 1),
             (2011, base.tolist(), 1)]
    return rows


def slow_links(rows):
    fine = {}
    for i, v, label in rows:
        ok = v and None not in v and all(np.isfinite(v)) and any(v)
        if i is not None and label is not None and ok:
            x = np.array(v) / np.abs(v).max()
            fine[i] = (x / np.linalg.norm(x), label)
    return [(a, b) for a in fine for b in fine if a < b and fine[a][1] == fine[b][1]
            and len(fine[a][0]) == len(fine[b][0]) and fine[a][0] @ fine[b][0] >= 0.93]


@pytest.mark.parametrize("block", [1024, 16])
def test_embedding_links(spark, block, monkeypatch):
    monkeypatch.setattr(pivots.links, "__defaults__", (pivots.THRESHOLD, pivots.SHARED, block))
    rows = vectors(block)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("v", F.lit(1)).repartition(3)
    got = pivots.near_duplicates(df.withColumn("pivot", F.lit("x"))).collect()
    assert len(got) == len(rows)
    links = slow_links(rows)
    nodes = {r[0] for r in rows if r[0] is not None}
    low = slow_components(nodes, links)
    for r in got:
        if r.vec_id is None:
            assert (r.n_links, r.component_id, r.kept) == (0, None, True)
        else:
            n = sum(r.vec_id in pair for pair in links)
            assert (r.n_links, r.component_id, r.kept) == (n, low[r.vec_id], r.vec_id == low[r.vec_id])


def test_every_vector_of_a_repeated_id_has_its_links(spark):
    rng = np.random.default_rng(8)
    a, b, c = (rng.normal(size=12) for _ in range(3))
    rows = [(1, a, 0), (2, b, 0), (3, c, 1), (4, a, 1), (9, a, 0), (9, b, 0), (9, c, 1), (9, c, 1), (9, 2 * c, 1), (8, b, 0), (8, 3 * b, 0)]
    df = spark.createDataFrame([(i, v.tolist(), n) for i, v, n in rows], "vec_id long, embedding array<double>, label int")
    got = pivots.near_duplicates(df.repartition(3)).collect()
    # 9 is linked with 1, 2, 3 and 8; 2 with 8 and 9; 4 has another label than 1.
    want = {1: (1, 1, True), 2: (2, 1, False), 3: (1, 1, False), 4: (0, 4, True), 8: (2, 1, False), 9: (4, 1, False)}
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in got) == sorted((r[0], *want[r[0]]) for r in rows)


def exact_links(x):
    """Links per row and lowest row of each component, by all products."""
    n, low, every = np.zeros(len(x), int), np.arange(len(x)), np.arange(len(x))
    for s in range(0, len(x), 500):
        own = every[s : s + 500]
        good = (x[own] @ x.T >= 0.93) & (own[:, None] != every[None, :])
        n[own] = good.sum(1)
        i, j = np.nonzero(good & (low[own][:, None] != low[None, :]))
        low = components.local_components(len(x), np.concatenate([every, own[i]]), np.concatenate([low, j]))
    return n, low


def dense(kind, rng, n=20_000, dim=64):
    """Unit rows of which a third are one dense group, or two groups of copies side by side."""
    x = rng.normal(size=(n, dim))
    base, hot = rng.normal(size=dim), n // 3
    base /= np.linalg.norm(base)
    if kind == "near":
        # Typical cosine within the group: 0.95.
        x[:hot] = base + rng.normal(size=(hot, dim)) * (0.05 / 0.95 / dim) ** 0.5
    else:
        side = rng.normal(size=dim)
        side -= (side @ base) * base
        side /= np.linalg.norm(side)
        c = {"linked": 0.9301, "apart": 0.9299}[kind]
        x[:hot] = base
        x[hot // 2 : hot] = c * base + (1 - c * c) ** 0.5 * side
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    return x[rng.permutation(n)]


@pytest.mark.parametrize("kind", ["near", "linked", "apart"])
def test_no_link_is_lost_in_dense_groups(spark, kind):
    x = dense(kind, np.random.default_rng(5))
    n, low = exact_links(x)
    df = spark.createDataFrame(
        pa.table({"vec_id": np.arange(len(x)), "embedding": pa.array(list(x)), "label": np.zeros(len(x), np.int32)})
    ).repartition(4)
    got = {r.vec_id: (r.n_links, r.component_id) for r in pivots.near_duplicates(df).collect()}
    assert got == {i: (int(n[i]), int(low[i])) for i in range(len(x))}


@pytest.mark.parametrize("spread", [0.01, 0.05, 0.2, 1.0])
def test_linked_vectors_meet_on_the_list_of_the_smaller_home(spread):
    """Whatever the density: rows around a few centres, from copies to no structure at all."""
    rng = np.random.default_rng(int(spread * 100))
    x = rng.normal(size=(5, 16))[rng.integers(0, 5, 1500)] + spread * rng.normal(size=(1500, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    p = pivots.thinned(x[:200], 0.93, 60)
    assert ((p @ p.T)[np.triu_indices(len(p), 1)] < 0.93).all()
    home, visits = pivots.visited(x @ p.T, np.sqrt(np.maximum(2 - 2 * p @ p.T, 0)), 0.93)
    i, j = np.nonzero(np.triu(x @ x.T >= 0.93, 1))
    first = np.minimum(home[i], home[j])
    assert ((home[i] == first) | visits[i, first]).all() and ((home[j] == first) | visits[j, first]).all()


def test_no_embeddings(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert pivots.near_duplicates(empty).collect() == []
    nulls = spark.createDataFrame([(1, None, 1), (2, None, None)], "vec_id long, embedding array<float>, label int")
    assert sorted(tuple(r) for r in pivots.near_duplicates(nulls).collect()) == [(1, 0, 1, True), (2, 0, 2, True)]


# --- documents ------------------------------------------------------------------------------------


def texts(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(2, 4)))
    rows = []
    for _ in range(50):
        words = [word() for _ in range(rng.randint(1, 120))]
        for _ in range(rng.randint(1, 7)):
            copy = list(words)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = word()
            rows.append((len(rows), rng.choice([" ", "  ", "\n"]).join(copy).upper() if rng.random() < 0.3 else " ".join(copy)))
    rows += [(1000, None), (1001, ""), (1002, " \x0b"), (1003, "a"), (1004, "A"), (1005, "a b"), (1006, "É é"), (1007, "é é"),
             (None, rows[0][1]), (1008, "same same"), (1008, "same same"), (1009, "w " * 20000), (1010, "W " * 300)]
    return rows


def shingle_set(text, size):
    words = (text or "").translate({c: " " for c in range(9, 14)}).split(" ")
    words = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in words if w]
    if len(words) < size:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


@pytest.mark.parametrize("size,percent,left", [(3, 85, 256), (5, 80, 4)])
def test_near_duplicate_documents(spark, size, percent, left, monkeypatch):
    monkeypatch.setattr(forest, "LEFT", left)
    rows = texts(size)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("rep", F.lit(1)).withColumn("d1", F.lit(2)).repartition(3)
    got = forest.near_duplicates(df, size, percent).collect()
    sets = [(i, shingle_set(t, size)) for i, t in rows if i is not None]
    links = []
    for a, x in sets:
        for b, y in sets:
            if a < b and x and y and 100 * len(x & y) >= percent * len(x | y):
                links.append((a, b))
    low = slow_components({i for i, _ in sets}, links)
    assert len(got) == len(rows) and links
    sizes = {i: len(s) for i, s in sets}
    for r in got:
        if r.doc_id is None:
            assert (r.component_id, r.kept) == (None, True)
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (sizes[r.doc_id], low[r.doc_id], low[r.doc_id] == r.doc_id)
    kept = forest.keep_first(df, size, percent)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in got if r.kept}


def test_a_large_group_of_near_copies_needs_few_confirmations(spark, monkeypatch):
    """Pairs confirmed follow the group's size, not its square."""
    rng = random.Random(9)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(300):
        copy = list(words)
        copy[rng.randrange(400)] = f"x{i}"
        rows.append((i, " ".join(copy)))
    seen = []
    plain = forest.confirmed
    monkeypatch.setattr(forest, "confirmed", lambda pairs, *rest: seen.append(pairs.count()) or plain(pairs, *rest))
    got = forest.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.component_id for r in got} == {0} and sum(seen) < 4 * len(rows)


def test_lone_pairs_at_the_threshold_are_found(spark):
    """10,000 pairs that share 80 of 100 words and have no other partner."""
    rows = []
    for i in range(10_000):
        words = [f"{i}-{k}" for k in range(100)]
        rows += [(2 * i, " ".join(words[:90])), (2 * i + 1, " ".join(words[:80] + words[90:]))]
    got = forest.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), 1, 80)
    assert got.where("kept").count() == 10_000


def test_no_threshold_misses_more_than_another():
    assert forest.tree_count(85) == 14
    for percent in (70, 75, 80, 85, 90, 99, 100):
        assert forest.missed(percent, forest.tree_count(percent)) <= forest.missed(85, 14)


def test_odd_and_empty_documents(docs, no_docs):
    rows = forest.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    assert {r.doc_id for r in rows if r.n_shingles == 0} == {1000, 1001, 1002}
    assert forest.near_duplicates(no_docs).collect() == []


def test_neighbours_across_partition_borders(spark):
    """Every two successive rows of a region are a pair, wherever the ranges are cut."""
    rows = [(0, region, bytes([k // 3]), 100 * region + k) for region in range(5) for k in range(30)]
    df = spark.createDataFrame(rows, "tree int, region long, key binary, rep long").repartition(4)
    pairs = {tuple(r) for r in forest.neighbours(df).collect()}
    assert pairs == {(100 * g + k, 100 * g + k + 1) for g in range(5) for k in range(29)}
