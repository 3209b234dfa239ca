"""Quality report over a flat record table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordlake.functions.text import is_filled, is_number, strip_ws
from recordlake.schema import SAMPLE_COLUMNS

LOW_FILL_PCT = 10
BAR_STEP_PCT = 5


def fill_rates(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Share of non-blank values per column, highest first, ties in column order.

    All columns are counted in one aggregate; the single result row is then turned into
    one row per column.
    """
    columns = list(columns or df.columns)
    counts = df.agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(is_filled(F.col(c).cast("string"))).alias(f"_c{i}")
          for i, c in enumerate(columns)],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(i).alias("col_pos"), F.lit(c).alias("column_name"),
                F.col(f"_c{i}").alias("n_filled"),
            )
            for i, c in enumerate(columns)
        ]
    )
    pct = F.when(F.col("_n") > 0, 100.0 * F.col("n_filled") / F.col("_n")).otherwise(F.lit(0.0))
    return (
        counts.select("_n", F.inline(rows))
        .select("col_pos", "column_name", "n_filled", pct.alias("pct"))
        .withColumn("bar", F.repeat(F.lit("#"), F.floor(F.col("pct") / BAR_STEP_PCT).cast("int")))
        .withColumn("is_low", F.col("pct") < LOW_FILL_PCT)
        .orderBy(F.desc("pct"), "col_pos")
    )


def quality_summary(df: DataFrame) -> DataFrame:
    """Row and column counts, values that are no coordinate, repeated ids; one pass."""
    aggs = [F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).alias("n_columns")]
    for c in ("latitude", "longitude"):
        if c in df.columns:
            aggs.append(F.count_if(~is_number(F.col(c))).alias(f"bad_{c}"))
    if "id" in df.columns:
        aggs.append((F.count("id") - F.count_distinct("id")).alias("duplicate_ids"))
    return df.agg(*aggs)


def out_of_range_coordinates(df: DataFrame) -> DataFrame:
    """Optional extra check: numeric coordinates beyond +-90 and +-180 degrees."""

    def beyond(c: str, limit: int) -> Column:
        value = F.when(is_number(F.col(c)), F.col(c).try_cast("double"))
        return F.count_if(F.abs(value) > limit).alias(f"{c}_out_of_range")

    return df.agg(beyond("latitude", 90), beyond("longitude", 180))


def value_counts(df: DataFrame, column: str, n: int | None = 20) -> DataFrame:
    """Rows per value, most frequent first, equal counts by value; blanks are a value."""
    counted = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    ordered = counted.orderBy(F.desc("n"), F.asc(column))
    return ordered if n is None else ordered.limit(n)


def split_values(df: DataFrame, column: str, sep: str = "; ") -> DataFrame:
    """One row per non-blank part of a delimited column, stripped."""
    parts = F.split(F.col(column), rf"\Q{sep}\E")
    return (
        df.select(F.explode(parts).alias(column))
        .select(strip_ws(F.col(column)).alias(column))
        .where(F.col(column) != "")
    )


def exploded_counts(df: DataFrame, column: str, sep: str = "; ") -> DataFrame:
    """Value counts over the parts of a delimited column."""
    return value_counts(split_values(df, column, sep), column, n=None)


def array_counts(df: DataFrame, column: str) -> DataFrame:
    """Value counts straight from an array column, safe when a value holds the separator."""
    items = df.select(F.explode(column).alias(column))
    return value_counts(items.where(is_filled(F.col(column))), column, n=None)


def sample_rows(df: DataFrame, order_by: Sequence[Column | str], n: int = 3) -> DataFrame:
    """The first rows in arrival order, with the display columns that exist."""
    shown = [c for c in SAMPLE_COLUMNS if c in df.columns]
    return df.orderBy(*order_by).limit(n).select(*shown)
