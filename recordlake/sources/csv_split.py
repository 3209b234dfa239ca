"""CSV files with line feeds inside quotes, read in splits.

Whether a line begins inside a quoted field is told by the number of quotes before it in the
file: odd or even. Each block of a file first adds up its own quotes; their parities, added
block by block, tell how every block begins. Then all blocks are cut into records side by
side. A record that goes on in the next block leaves a piece in each; only those are joined.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recordlake.schema import OUTPUT_COLUMNS
from recordlake.sources.raw import with_file

# Texts of a batch of records that is handed on.
BATCH_CHARS = 1 << 20
_SCHEMA = "file_path string, block_start long, no long, kind string, text string"


def inside_quotes(lines: DataFrame) -> dict[tuple[str, int], bool]:
    """Blocks that begin inside a quoted field: at most a row per block."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    blocks = lines.groupBy("file_path", "block_start").agg((F.sum(quotes) % 2).alias("odd"))
    before = Window.partitionBy("file_path").orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.withColumn("inside", F.coalesce(F.sum("odd").over(before) % 2, F.lit(0)) == 1)
    return {(r["file_path"], r["block_start"]): True for r in starts.where("inside").collect()}


def _cut(batches, inside: dict[tuple[str, int], bool]):
    """Records and pieces of records (``head``, ``tail``, or ``middle`` for a whole block)."""
    place, odd, headless, held, no, done, size = None, False, False, [], 0, [], 0

    def closed(kind):
        nonlocal held, no, size
        done.append((*place, no, kind, "\n".join(held)))
        size += sum(map(len, held))
        held, no = [], no + 1

    def written():
        nonlocal done, size
        columns = list(zip(*done))
        types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        done, size = [], 0
        names = ["file_path", "block_start", "no", "kind", "text"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    def ended():
        if held:
            closed("middle" if odd and headless else "tail" if odd else "head" if headless else "whole")

    for batch in batches:
        for value, path, block in zip(*(c.to_pylist() for c in batch.columns)):
            if (path, block) != place:
                ended()
                place, no = (path, block), 0
                odd = headless = inside.get(place, False)
            held.append(value)
            odd ^= value.count('"') % 2 == 1
            if not odd:
                closed("head" if headless else "whole")
                headless = False
            if size > BATCH_CHARS:
                yield written()
    ended()
    if done:
        yield written()


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """Texts of the records of CSV files: file_path, block_start, no (in the block) and text.

    The order of the three is that of the file. Headers are records too; empty lines are not.
    A record that spans blocks has the place of its beginning.
    """
    lines = with_file(spark.read.option("lineSep", "\n").text(path))
    sent = spark.sparkContext.broadcast(inside_quotes(lines))
    cut = lines.mapInArrow(lambda batches: _cut(batches, sent.value), _SCHEMA)
    order = Window.partitionBy("file_path").orderBy("block_start", "no")
    # At most two pieces per block; a record's pieces follow the tail they belong to.
    pieces = cut.where("kind <> 'whole'").withColumn("_record", F.sum(F.when(F.col("kind") == "tail", 1).otherwise(0)).over(order))
    joined = pieces.groupBy("file_path", "_record").agg(
        F.min(F.struct("block_start", "no")).alias("_at"),
        F.sort_array(F.collect_list(F.struct("block_start", "no", "text"))).alias("_pieces"),
    ).select("file_path", "_at.*", F.array_join("_pieces.text", "\n").alias("text"))
    whole = cut.where("kind = 'whole'").drop("kind")
    return whole.unionByName(joined).where(F.trim(F.replace("text", F.lit("\r"), F.lit(""))) != "")


def read_csv_split(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """As ``raw.read_csv``: result files as text columns, but each file in as many tasks as it
    has blocks."""
    columns = columns or OUTPUT_COLUMNS
    ddl = ", ".join(f"`{c}` string" for c in columns)
    options = {"escape": '"', "nullValue": "\u0000", "emptyValue": "", "maxCharsPerColumn": "-1"}
    records = csv_records(spark, path)
    rows = records.where((F.col("block_start") > 0) | (F.col("no") > 0)).select(F.from_csv("text", ddl, options).alias("_row"))
    return rows.select("_row.*").na.fill("")
