"""Readers for raw responses, listings, pages, traffic logs and result files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordlake.functions import typed
from recordlake.schema import OUTPUT_COLUMNS

# Arrival order of a raw line: file, block of the file, line in scan order.
ARRIVAL = ["file_path", "block_start", "line_id"]

ATTEMPT_DDL = "batch_idx long, attempt int, status int, error string, body string"
TRAFFIC_DDL = (
    "t double, method string, url string, status int, content_type string, body string"
)


def with_file(lines: DataFrame) -> DataFrame:
    """Text lines with their file and block."""
    return lines.select(
        "value",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
    )


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """One row per line of raw JSON, with its arrival order.

    Files are split as usual: inside one block lines keep their order, blocks and files
    are ordered by their own columns.
    """
    return with_line_ids(with_file(spark.read.text(path)))


def with_line_ids(lines: DataFrame) -> DataFrame:
    """Number the lines of each block in their order; numbers of blocks are not comparable."""
    return lines.withColumn("line_id", F.monotonically_increasing_id())


def stream_raw(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """The same lines as an unbounded table."""
    reader = spark.readStream.format("text")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return with_file(reader.load(path))


def listing_entries(text: Column) -> Column:
    """Entries of a listing response as typed text; empty when it has none or is broken."""
    listed = typed.items(typed.fields(typed.typed_json(text))["partnerLocations"])
    return F.coalesce(listed, F.array().cast("array<string>"))


def explode_locations(listings: DataFrame, text: str = "value", keep=()) -> DataFrame:
    """One row per listed location whose entry has an ``id`` key, even a null one."""
    entries = listings.select(*keep, F.posexplode(listing_entries(F.col(text))).alias("pos", "_entry"))
    with_id = entries.where(F.array_contains(F.json_object_keys("_entry"), "id"))
    opened = with_id.select(
        *keep, "pos", "_entry",
        F.from_json("_entry", "id string, latitude string, longitude string, countryId string").alias("_l"),
    )
    value = lambda name: typed.text_of(F.col(f"_l.{name}"))
    return opened.select(
        *keep, "pos", typed.compact_json(F.col("_entry")).alias("entry"),
        value("id").try_cast("bigint").alias("id"),
        *[value(c).try_cast("double").alias(c) for c in ("latitude", "longitude")],
        value("countryId").alias("countryId"),
    )


def broken_listings(listings: DataFrame, text: str = "value") -> DataFrame:
    """Listing responses that are no JSON at all."""
    return listings.withColumn("_typed", typed.typed_json(F.col(text))).where("_typed IS NULL").drop("_typed")


def read_locations(spark: SparkSession, path: str) -> DataFrame:
    """Locations from listing files, one JSON document per file."""
    return explode_locations(spark.read.text(path, wholetext=True))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Page or script text, one row per file, keyed by base name."""
    return spark.read.text(path, wholetext=True).select(
        F.substring_index(F.col("_metadata.file_path"), "/", -1).alias("name"),
        F.col("value").alias("text"),
    )


def read_traffic(spark: SparkSession, path: str) -> DataFrame:
    """Captured requests and responses from JSON lines."""
    return spark.read.schema(TRAFFIC_DDL).json(path)


def read_attempts(spark: SparkSession, path: str) -> DataFrame:
    """Log of fetch attempts from JSON lines."""
    return spark.read.schema(ATTEMPT_DDL).json(path)


def read_csv(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Result files as text columns; blanks stay blank."""
    ddl = ", ".join(f"`{c}` string" for c in (columns or OUTPUT_COLUMNS))
    table = (
        spark.read.schema(ddl)
        .option("header", True)
        .option("escape", '"')
        .option("multiLine", True)
        .option("nullValue", "\u0000")
        .option("emptyValue", "")
        .csv(path)
    )
    return table.na.fill("")
