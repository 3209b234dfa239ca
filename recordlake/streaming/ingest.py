"""The same unwrap, flatten and de-duplicate steps on an unbounded table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from recordlake.operators.dedupe import digest
from recordlake.plans.run import ORDER, RunResult, arrivals, finish, first_arrivals
from recordlake.schema import FINGERPRINT_COLUMNS
from recordlake.sources.raw import stream_raw, with_line_ids

DEFAULT_SPREAD = 16


def drop_seen(
    rows: DataFrame,
    key: Column,
    spread_by: Column | None = None,
    spread: int = DEFAULT_SPREAD,
    event_time: str | None = None,
    delay: str | None = None,
) -> DataFrame:
    """Pass each key once, with state kept across batches.

    A first round removes repeats inside ``spread`` slices of a key, by default slices of a
    hash of the whole row, so a key that makes up much of the stream is handled by many
    tasks; the second round then meets it at most ``spread`` times. State holds a 32-byte
    digest per key. It is kept for good, unless an event time and a delay allow old keys to
    be forgotten. Which of a key's rows passes is not defined; ``run_stream`` is for that.
    """
    by = spread_by if spread_by is not None else F.xxhash64(*rows.columns)
    marked = rows.withColumn("_key", digest(key)).withColumn("_slice", F.pmod(F.xxhash64(by), F.lit(spread)))
    if event_time is not None:
        marked = marked.withWatermark(event_time, delay)

    def once(df: DataFrame, columns: list[str]) -> DataFrame:
        if event_time is not None:
            return df.dropDuplicatesWithinWatermark(columns)
        return df.dropDuplicates(columns)

    return once(once(marked, ["_key", "_slice"]).drop("_slice"), ["_key"]).drop("_key")


def drain(rows: DataFrame, path: str, checkpoint: str, fmt: str = "parquet") -> StreamingQuery:
    """Write everything that is available now, then stop; a restart resumes."""
    return (
        rows.writeStream.format(fmt)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def land_arrivals(raw: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """First arrivals of every batch, with their copies, in a folder per batch.

    A batch that is repeated after a failure overwrites its own folder.
    """

    def land(batch: DataFrame, batch_id: int) -> None:
        first = first_arrivals(arrivals(with_line_ids(batch)))
        first.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/batch={batch_id}")

    return (
        raw.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def run_stream(
    spark: SparkSession,
    raw_path: str,
    out_dir: str,
    checkpoint: str,
    max_files: int | None = None,
    backup: bool = False,
) -> list[StreamingQuery]:
    """Start the record stream and, if asked, the verbatim backup of its input.

    What is available is landed as arrivals, then the queries stop; a restart resumes.
    ``landed_records`` reads the records so far, ``finish_stream`` ends the run.
    """
    raw = stream_raw(spark, raw_path, max_files)
    queries = [land_arrivals(raw, f"{out_dir}/arrivals", f"{checkpoint}/arrivals")]
    if backup:
        lines = stream_raw(spark, raw_path, max_files).select("value")
        queries.append(drain(lines, f"{out_dir}/raw", f"{checkpoint}/raw", "text"))
    return queries


def landed_records(spark: SparkSession, out_dir: str, columns: Sequence[str] | None = None) -> DataFrame:
    """First arrivals over all landed batches: the same rows as in a batch run.

    Copies of a record in different batches are told apart by file, block and line, not by
    which batch came first. With ``columns`` only these, and what tells copies, are shuffled.
    """
    landed = spark.read.parquet(f"{out_dir}/arrivals").drop("batch")
    if columns is None:
        return first_arrivals(landed, F.col("copies"))
    needed = {*columns, *FINGERPRINT_COLUMNS, *ORDER, "rejected", "copies"}
    narrow = landed.select(*[c for c in landed.columns if c in needed])
    return first_arrivals(narrow, F.col("copies")).select(*columns)


def finish_stream(
    spark: SparkSession, out_dir: str, run_ts: str, formats: Sequence[str] = ("csv",), **options
) -> RunResult:
    """Records, export, reports and audit of a drained stream, as at the end of a batch run."""
    return finish(spark, landed_records(spark, out_dir), out_dir, run_ts, formats, **options)
