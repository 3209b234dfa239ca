"""Exact line numbers of raw files that are read in splits, the same in batch and stream.

Blocks of a file count their lines first; the counts of the blocks before it tell how a block
begins. Numbers then follow from the place in the block, so they are what an editor shows,
whatever the size of the splits and whichever batch a file came in.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from recordlake.sources.raw import stream_raw, with_file

LINE_PLACE = ["file_path", "line_no"]


def numbered(lines: DataFrame) -> DataFrame:
    """(file_path, line_no from 1, value) of lines with ``file_path`` and ``block_start``.

    ``lines`` must come straight from a text scan, whose partitions hold the lines of a block
    in their order. They are read twice and not shuffled; only a row per block is collected.
    """
    blocks = lines.groupBy("file_path", "block_start").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("file_path").orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    firsts = blocks.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0)))
    sent = lines.sparkSession.sparkContext.broadcast(
        {(r["file_path"], r["block_start"]): r["first"] for r in firsts.where("first > 0").collect()}
    )

    def count(batches):
        place, no = None, 0
        for batch in batches:
            numbers = []
            for here in zip(batch["file_path"].to_pylist(), batch["block_start"].to_pylist()):
                if here != place:
                    place, no = here, sent.value.get(here, 0)
                no += 1
                numbers.append(no)
            yield pa.RecordBatch.from_arrays([batch["file_path"], pa.array(numbers, pa.int64()), batch["value"]], [*LINE_PLACE, "value"])

    placed = lines.select("file_path", "block_start", "value")
    return placed.mapInArrow(count, "file_path string, line_no long, value string")


def read_numbered(spark: SparkSession, path: str) -> DataFrame:
    """Raw lines of files with their numbers."""
    return numbered(with_file(spark.read.text(path)))


def land_numbered(
    spark: SparkSession, path: str, out: str, checkpoint: str, max_files: int | None = None
) -> StreamingQuery:
    """The same rows from a stream of files, a folder per batch; a repeated batch overwrites
    its own. A file is in one batch, so its numbers need nothing from other batches."""

    def land(batch: DataFrame, batch_id: int) -> None:
        numbered(batch).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return (
        stream_raw(spark, path, max_files).writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
