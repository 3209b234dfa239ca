"""Bounded samples: the rows of a full sort, from few of them."""

import pytest
from pyspark.sql import functions as F

from recordlake.llm.store import bounded


@pytest.mark.parametrize("kind", ["distinct", "repeated", "null", "few", "none"])
def test_bounded_rows_are_those_of_a_full_sort(spark, kind):
    key = {
        "distinct": F.col("id"), "repeated": F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")), "null": F.lit(None).cast("long"),
        "few": F.col("id"), "none": F.col("id"),
    }[kind]
    n = {"few": 30, "none": 0}.get(kind, 4000)
    df = spark.range(n).repartition(24).select(key.alias("k"), (F.col("id") % 5).alias("v"))
    want = df.orderBy(F.xxhash64("k", F.lit(7)), "k").limit(40).select("k").collect()
    got = bounded(df, "k", 40)
    assert [r.k for r in got.collect()] == [r.k for r in want] and got.columns == ["k", "v"]


def test_few_rows_are_ordered(spark):
    """Of 100,000 rows in 50 partitions about four times the bound pass the filter."""
    df = spark.range(100_000).repartition(50).withColumnRenamed("id", "k")
    plan = bounded(df, "k", 100)._jdf.queryExecution().optimizedPlan()
    below = [x for x in plan.toString().splitlines() if "Filter" in x and "xxhash64" in x]
    assert len(below) == 1
    share = float(below[0].split("<")[1].strip(" )").rstrip(")"))
    assert df.where(F.xxhash64("k", F.lit(7)) < F.lit(int(share))).count() < 1000
