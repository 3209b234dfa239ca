"""Tables written to the folder that all executors share, so that lineage ends there."""

from __future__ import annotations

import gc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordlake.session import scratch_path, small_batches


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet below ``spark.checkpoint.dir`` and read again.

    Executors can be lost later without this work being repeated.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(*frames: DataFrame) -> None:
    """Delete tables made by :func:`stored` that nothing reads any more."""
    for df in frames:
        spark = df.sparkSession
        for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def forget_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner drop shuffle files of plans that are no longer referenced."""
    gc.collect()
    spark._jvm.System.gc()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id="doc_id"):
    """The rows that no classifier may learn from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def bounded(df: DataFrame, key: str, bound: int, seed: int = 7) -> DataFrame:
    """At most ``bound`` rows of a narrow table: those with the smallest hashes of ``key``.

    Rows beyond a hash that about four times as many rows lie below are left out before they
    are ordered, so what is ordered, and what reaches one place, does not grow with the number
    of partitions. If repeated keys leave too few, the share is raised; the rows are the same.
    """
    place = F.xxhash64(F.col(key), F.lit(seed))
    share = 4 * bound / max(df.count(), 1)
    some = df
    while share < 1:
        below = df.where(place < F.lit(int(share * 2**64) - 2**63))
        if below.count() >= bound:
            some = below
            break
        share *= 4
    return some.orderBy(place, F.col(key)).limit(bound)


def small(df: DataFrame, rows: int = 1_000_000) -> DataFrame:
    """A narrow table, marked for broadcast if it is counted to have at most ``rows`` rows.

    Larger ones are joined by a shuffle.
    """
    return F.broadcast(df) if df.count() <= rows else df
