"""Writers: raw backup, CSV, JSON by country, tables, failed ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BOM = "﻿"

# Every value quoted, quotes doubled, blanks written as "".
CSV_OPTIONS = {
    "quoteAll": True,
    "escape": '"',
    "emptyValue": "",
    "nullValue": "",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def run_path(base: str, name: str, run_ts: str) -> str:
    """Outputs of one run share a stamp: ``<base>/<name>/run_ts=<stamp>``."""
    return f"{base.rstrip('/')}/{name}/run_ts={run_ts}"


# Lines of a compressed file, which one task has to read.
COMPRESSED_LINES = 10_000


def write_raw(raw: DataFrame, path: str, compression: str = "none") -> None:
    """The raw lines as they came; compressed ones in files of a bounded number of lines."""
    most = 0 if compression == "none" else COMPRESSED_LINES
    raw.select("value").write.option("compression", compression).option("maxRecordsPerFile", most).text(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Part files, each with the header."""
    df.write.options(**CSV_OPTIONS).option("header", True).csv(path)


def export_csv(df: DataFrame, path: str, order_by: Sequence[str] = ()) -> None:
    """Parts that join up to one file: ``header`` (byte order mark, names), then ``rows``.

    Rows are written in parallel, in arrival order over the part files, so the whole never
    passes one task: concatenating ``header/part-*`` and ``rows/part-*`` gives the file.
    """
    columns = [c for c in df.columns if c not in order_by]
    names = ",".join('"' + c.replace('"', '""') + '"' for c in columns)
    header = df.sparkSession.range(1).select(F.lit(BOM + names).alias("value"))
    header.write.text(f"{path}/header")
    ordered = df.orderBy(*order_by) if order_by else df
    ordered.select(*columns).write.options(**CSV_OPTIONS).csv(f"{path}/rows")


def write_by_country(df: DataFrame, path: str, column: str = "country", blank: str = "(blank)") -> None:
    """JSON records in one folder per country, null and blank ones in a folder named ``blank``.

    Fields keep their values, null ones included; only the folder has the name. The rebalance
    hint gathers small countries and lets adaptive execution split large ones over several
    files.
    """
    name = F.when(F.coalesce(F.col(column), F.lit("")) == "", F.lit(blank)).otherwise(F.col(column))
    spread = df.withColumn("results", name).hint("rebalance", F.col("results"))
    spread.write.partitionBy("results").option("ignoreNullFields", False).json(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Records in any Spark file format; CSV gets the quoting rules above."""
    if fmt == "csv":
        write_csv(df, path)
    else:
        df.write.format(fmt).save(path)


def write_failed_ids(lost: DataFrame, path: str) -> None:
    """Ids of failed batches as JSON lines, input for a later run."""
    lost.write.json(path)
