"""First-wins removal of repeated records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordlake.schema import FINGERPRINT_COLUMNS


def fingerprint() -> Column:
    """Lower-cased id, company, city and country, joined by ``||``."""
    parts = [F.coalesce(F.col(c), F.lit("")) for c in FINGERPRINT_COLUMNS]
    return F.lower(F.concat_ws("||", *parts))


def first_by(df: DataFrame, keys: Sequence[Column | str], order_by: Sequence[Column | str]) -> DataFrame:
    """The first row of each key in the given order.

    ``row_number() = 1`` is planned with a group limit ahead of the shuffle, so a map
    task sends at most one row per key however often the key occurs.
    """
    ranked = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_rank", F.row_number().over(ranked)).where("_rank = 1").drop("_rank")


def digest(text: Column) -> Column:
    """32 bytes that stand for a text of any length in sorts, shuffles and state."""
    return F.unhex(F.sha2(text, 256))


def first_wins(records: DataFrame, order_by: Sequence[Column | str]) -> DataFrame:
    """Keep the first arrival of every fingerprint."""
    marked = records.withColumn("_fp", digest(fingerprint()))
    return first_by(marked, ["_fp"], order_by).drop("_fp")


def first_and_count(
    rows: DataFrame, key: Column, order_by: Sequence[str], copies: Column | None = None
) -> DataFrame:
    """The first row of each key and ``copies``, how many rows the key had.

    The smallest row by ``order_by`` is an aggregate like the count, so both are combined
    before the shuffle and a key that holds much of the table sends a row per map task.
    ``copies`` may give a count per row, for rows that are first arrivals themselves.
    """
    rest = [c for c in rows.columns if c not in order_by and c != "copies"]
    counted = F.sum(copies) if copies is not None else F.count(F.lit(1))
    reduced = rows.groupBy(key.alias("_key")).agg(
        F.min(F.struct(*order_by, *rest)).alias("_row"), counted.alias("copies")
    )
    return reduced.select("_row.*", "copies")


def first_position_last_value(
    df: DataFrame, key: str, position: str, columns: Sequence[str], n: int | None = None
) -> DataFrame:
    """One row per key at its first position, with the values seen last.

    Both ends are plain aggregates, combined before the shuffle.
    """
    last = F.max_by(F.struct(*columns), F.col(position))
    out = (
        df.groupBy(key)
        .agg(F.min(position).alias("first_pos"), last.alias("_last"))
        .select(key, "first_pos", "_last.*")
    )
    return out if n is None else out.orderBy("first_pos").limit(n)
