"""Stored runs with digests per range of ids, so that a delta only reads what differs.

The rows of a run are stored in ranges of a hash of the id. Each range has a count and a
digest of its rows; sixteen ranges make one of the level above, up to a single digest for the
whole run. Two runs are compared from the top: only below digests that differ are the next
ones looked at, and only rows of the lowest ranges that differ are joined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordlake.operators.dedupe import first_by
from recordlake.operators.delta import snapshot_delta

# Ranges at the lowest level: a power of 16.
LEVELS = 4
_FAN = 16
_DIGEST = ["n_rows", "total", "parity"]


def _range(key: str, levels: int) -> Column:
    # An id counts by its text, so two runs may store it with different types; null is an id.
    text = F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit(""))
    return F.pmod(F.xxhash64(text, F.lit(5)), F.lit(_FAN**levels)).cast("int")


def store_run(
    records: DataFrame, path: str, order_by: Sequence[Column | str], columns: Sequence[str], key: str = "id",
    levels: int = LEVELS,
) -> None:
    """Write the first row of each id and the digests of its ranges below ``path``.

    Rows are sorted by range over the files, so a reader of a few ranges skips most of them.
    """
    columns = [c for c in columns if c != key]
    rows = first_by(records, [key], order_by).select(key, *columns).withColumn("_range", _range(key, levels))
    rows.repartitionByRange("_range", F.xxhash64(key)).sortWithinPartitions("_range").write.parquet(f"{path}/rows")
    stored = records.sparkSession.read.parquet(f"{path}/rows")
    # The text shows nulls and where a value ends; sums and parities of its hashes need no order.
    text = F.to_json(F.struct(key, *columns), {"ignoreNullFields": "false"})
    digests = stored.select("_range", F.xxhash64(text, F.lit(1)).alias("a"), F.xxhash64(text, F.lit(2)).alias("b")).groupBy(
        "_range"
    ).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("a").cast("decimal(38,0)")).alias("total"),
        F.bit_xor("b").alias("parity"),
    ).withColumn("level", F.lit(levels))
    digests.select("level", "_range", *_DIGEST).write.parquet(f"{path}/digests/lowest")
    lowest = records.sparkSession.read.parquet(f"{path}/digests/lowest")
    # At most 16 ** levels rows, combined upwards.
    every = lowest
    for level in range(levels - 1, -1, -1):
        share = F.shiftright("_range", 4 * (levels - level)).alias("_range")
        above = lowest.select(share, *_DIGEST).groupBy("_range").agg(
            F.sum("n_rows").alias("n_rows"), F.sum("total").alias("total"), F.bit_xor("parity").alias("parity")
        )
        every = every.unionByName(above.withColumn("level", F.lit(level)).select(*lowest.columns))
    every.coalesce(1).write.parquet(f"{path}/digests/levels")


def changed_ranges(spark: SparkSession, previous: str, current: str) -> list[int]:
    """Lowest ranges whose digests differ, found from the top; at most 16 ** levels numbers."""
    old, new = (spark.read.parquet(f"{p}/digests/levels") for p in (previous, current))
    heights = [df.agg(F.max("level")).first()[0] for df in (old, new)]
    if None in heights:  # an empty run has no digests
        filled = new if heights[0] is None else old
        lowest = filled.where(F.col("level") == filled.agg(F.max("level")).first()[0])
        return sorted(r["_range"] for r in lowest.select("_range").collect())
    if heights[0] != heights[1]:
        raise ValueError("the runs were stored with different numbers of levels")
    wanted: list[int] = [0]
    for level in range(heights[0] + 1):
        # The only range of the top is its own parent.
        parents = F.broadcast(spark.createDataFrame([(r,) for r in wanted], "_parent int"))
        below = F.shiftright("_range", 4) == F.col("_parent")
        own = [
            df.where(F.col("level") == level).join(parents, below, "left_semi").select("_range", *_DIGEST)
            for df in (old, new)
        ]
        # A row that only one side has, or in another form, is a difference.
        wanted = sorted({r["_range"] for a, b in (own, own[::-1]) for r in a.exceptAll(b).select("_range").collect()})
        if not wanted:
            break
    return wanted


def changed_rows(spark: SparkSession, previous: str, current: str) -> tuple[DataFrame, DataFrame]:
    """Stored rows of both runs that are in ranges that differ."""
    ranges = spark.createDataFrame([(r,) for r in changed_ranges(spark, previous, current)], "_range int")
    lowest = F.broadcast(ranges)
    # The bounds reach the file scan; the join picks the ranges.
    low, high = ranges.agg(F.min("_range"), F.max("_range")).first()

    def side(path: str) -> DataFrame:
        rows = spark.read.parquet(f"{path}/rows").where(F.col("_range").between(F.lit(low), F.lit(high)))
        return rows.join(lowest, "_range", "left_semi").drop("_range")

    return side(previous), side(current)


def stored_delta(spark: SparkSession, previous: str, current: str, columns: Sequence[str], key: str = "id") -> DataFrame:
    """``snapshot_delta`` of two stored runs: the same rows, joining only ranges that differ."""
    old, new = changed_rows(spark, previous, current)
    return snapshot_delta(old, new, [c for c in columns if c != key], columns, key)
