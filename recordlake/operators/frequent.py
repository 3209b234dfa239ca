"""The most frequent values without a shuffle of all distinct ones.

Every task keeps a summary of bounded size of its values: counts that are too low by at most
the number of times that all counters were lowered. Summaries give each value a lowest and a
highest possible count. Values whose highest count does not reach the n-th largest lowest one
cannot be among the first n, so only the others are counted exactly, in a second pass.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlake.session import scratch_path

# Counters per task, and candidates that are counted exactly.
COUNTERS = 4096
MOST_CANDIDATES = 100_000


def lowered(counts: Counter, size: int) -> int:
    """Lower all counters until at most ``size`` are left; by how much."""
    if len(counts) <= size:
        return 0
    # What the first counter that has to go holds, taken from all.
    by = sorted(counts.values(), reverse=True)[size]
    for value in [v for v, n in counts.items() if n <= by]:
        del counts[value]
    for value in counts:
        counts[value] -= by
    return by


def summaries(df: DataFrame, column: str, size: int = COUNTERS) -> DataFrame:
    """(value, low, missing): per task at most ``size`` values with counts that are at most
    ``missing`` too low; any other value of the task occurs at most ``missing`` times. A task's
    first row has a null value and ``missing`` alone. Null values are not counted."""

    def build(batches):
        counts, missing = Counter(), 0
        for batch in batches:
            for entry in pc.value_counts(batch.column(0).drop_null()).to_pylist():
                counts[entry["values"]] += entry["counts"]
            if len(counts) > 2 * size:
                missing += lowered(counts, size)
        missing += lowered(counts, size)
        values = [None, *counts]
        yield pa.RecordBatch.from_arrays(
            [pa.array(values, pa.string()), pa.array([0, *counts.values()], pa.int64()), pa.array([missing] * len(values), pa.int64())],
            ["value", "low", "missing"],
        )

    return df.select(F.col(column).cast("string").alias("value")).mapInArrow(build, "value string, low long, missing long")


def candidates(parts: DataFrame, n: int) -> DataFrame:
    """Values that may be among the ``n`` most frequent, from their summaries."""
    error = parts.where("value IS NULL").agg(F.coalesce(F.sum("missing"), F.lit(0)).alias("_error"))
    bounds = parts.where("value IS NOT NULL").groupBy("value").agg(
        F.sum("low").alias("low"), F.sum("missing").alias("_own"), F.sum(F.col("low") + F.col("missing")).alias("_high")
    )
    # Where a value is not in a task's summary it may still occur ``missing`` times.
    total = error.first()["_error"]
    least = bounds.orderBy(F.desc("low")).limit(n).agg(F.count(F.lit(1)).alias("n"), F.min("low").alias("low")).first()
    bar = least["low"] if least["n"] == n else 0
    high = F.col("_high") + F.lit(total) - F.col("_own")
    # A value that no summary has may occur ``total`` times: with such a bar nothing is proven.
    proven = F.lit(total < bar or total == 0)
    return bounds.select("value", (high >= bar).alias("may"), proven.alias("proven"))


def top_values(df: DataFrame, column: str, n: int = 20, size: int = COUNTERS) -> DataFrame:
    """(column, n): the ``n`` most frequent values with their counts, equal counts by value.

    The same rows as a count of all values, nulls left out. If the summaries prove nothing,
    as where all values are about equally frequent, all values are counted.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "frequent")
    summaries(df, column, size).write.parquet(path)
    found = candidates(spark.read.parquet(path), n)
    sure = found.agg(F.count_if("may").alias("n"), F.min("proven").alias("proven")).first()
    values = df.select(F.col(column).cast("string").alias("_value")).where("_value IS NOT NULL")
    if sure["n"] and sure["proven"] and sure["n"] <= MOST_CANDIDATES:
        values = values.join(F.broadcast(found.where("may").select(F.col("value").alias("_value"))), "_value", "left_semi")
    counted = values.groupBy("_value").agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy(F.desc("n"), "_value").limit(n).select(F.col("_value").alias(column), "n")
