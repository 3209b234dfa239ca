"""Most frequent values by summaries against a count of all values."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from recordlake.operators import frequent


def top(values, n):
    return sorted(Counter(v for v in values if v is not None).items(), key=lambda x: (-x[1], x[0]))[:n]


def skewed(seed, n, distinct):
    rng = random.Random(seed)
    return [None if rng.random() < 0.02 else str(int(distinct * rng.random() ** 6)) for _ in range(n)]


@pytest.mark.parametrize("size", [3, 40, 4096])
@pytest.mark.parametrize("kind", ["skewed", "flat", "ties", "few", "none"])
def test_top_values_equal_a_full_count(spark, kind, size):
    values = {
        "skewed": skewed(1, 20000, 5000), "flat": [str(i) for i in range(3000)], "ties": [str(i % 50) for i in range(5000)],
        "few": ["b", "a", "", None], "none": [],
    }[kind]
    df = spark.createDataFrame([(v,) for v in values], "v string").repartition(5)
    got = frequent.top_values(df, "v", 20, size)
    assert got.columns == ["v", "n"] and [tuple(r) for r in got.collect()] == top(values, 20)


def test_candidates_do_not_grow_with_the_distinct_values(spark):
    """Ten times as many rare values: as many rows of summaries, and no more candidates."""
    sizes = []
    for rare in (5_000, 50_000):
        common = spark.range(20_000).select((F.col("id") % 25).cast("string").alias("v"))
        df = common.union(spark.range(rare).select(F.concat(F.lit("r"), "id").alias("v"))).repartition(4)
        parts = frequent.summaries(df, "v", 200)
        found = frequent.candidates(parts, 20)
        assert found.where("NOT proven").count() == 0
        sizes.append((parts.count(), found.where("may").count()))
        assert {r.v for r in frequent.top_values(df, "v", 20, 200).collect()} == {v for v, _ in top([str(i % 25) for i in range(20000)], 20)}
    assert sizes[1][0] <= 4 * 201 and sizes[1][1] <= sizes[0][1] + 25


def test_summaries_bound_every_count(spark):
    values = skewed(4, 30000, 2000)
    df = spark.createDataFrame([(v,) for v in values], "v string").repartition(3)
    parts = frequent.summaries(df, "v", 50).collect()
    error = sum(r.missing for r in parts if r.value is None)
    low, own = Counter(), Counter()
    for r in parts:
        if r.value is not None:
            low[r.value] += r.low
            own[r.value] += r.missing
    for value, n in Counter(v for v in values if v is not None).items():
        assert low[value] <= n <= low[value] + error
