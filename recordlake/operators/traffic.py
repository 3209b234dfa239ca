"""Operators over a captured traffic log (time, method, url, status, content type, body)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordlake.functions import typed
from recordlake.functions.text import contains_any


def micros(gap: Column) -> Column:
    """A day-time interval in microseconds."""
    days, hours = F.extract(F.lit("DAY"), gap), F.extract(F.lit("HOUR"), gap)
    minutes, seconds = F.extract(F.lit("MINUTE"), gap), F.extract(F.lit("SECOND"), gap)
    whole = ((days * 24 + hours) * 60 + minutes).cast("bigint") * 60_000_000
    return whole + (seconds * 1_000_000).cast("bigint")


def with_elapsed(log: DataFrame, ts: str = "ts") -> DataFrame:
    """Microseconds since the first event of the whole log."""
    start = log.agg(F.min(ts)).scalar()
    timed = log.withColumn("_gap", F.col(ts) - start)
    return timed.withColumn("elapsed_us", micros(F.col("_gap"))).drop("_gap")


def with_session_elapsed(log: DataFrame, session: str, ts: str = "ts") -> DataFrame:
    """Microseconds since the first event of the row's session; null is a session too.

    The start times are a combined aggregate joined back, so a session that holds much of
    the log is never gathered in one task.
    """
    starts = log.groupBy(F.col(session).alias("_session")).agg(F.min(ts).alias("_start"))
    same = F.col(session).eqNullSafe(F.col("_session"))
    timed = log.join(starts, same).withColumn("_gap", F.col(ts) - F.col("_start"))
    return timed.withColumn("elapsed_us", micros(F.col("_gap"))).drop("_session", "_start", "_gap")


def after_mark(log: DataFrame, mark, column: str = "seq") -> DataFrame:
    """Rows at or behind a checkpoint."""
    return log.where(F.col(column) >= mark)


def api_responses(
    log: DataFrame,
    content_types: Sequence[str] = ("json", "javascript"),
    status: int | None = None,
    method: str | None = None,
    keywords: Sequence[str] = (),
) -> DataFrame:
    """Filter by content type, status, method and words in the address."""
    kept = log.where(contains_any(F.col("content_type"), content_types))
    if status is not None:
        kept = kept.where(F.col("status") == status)
    if method is not None:
        kept = kept.where(F.col("method") == method)
    if keywords:
        kept = kept.where(contains_any(F.col("url"), keywords))
    return kept


def mentions_value(url: Column, body: Column, parameter: str, value: str) -> Column:
    """True when the address sets a parameter to a value or the body mentions the value."""
    in_body = F.contains(F.lower(F.coalesce(body, F.lit(""))), F.lit(value.lower()))
    return F.contains(url, F.lit(f"{parameter}={value}")) | in_body


def request_ids(
    log: DataFrame, body: str = "body", keep: Sequence[str] = (), sample: int = 5, preview: int = 150
) -> DataFrame:
    """Id lists sent in request bodies: length and first ids, else a preview of the body."""
    filled = log.where(F.col(body) != "").select(*keep, body, typed.typed_json(F.col(body)).alias("_typed"))
    ids = typed.items(typed.fields(F.col("_typed"))["ids"])
    return filled.select(*keep, body, ids.alias("_ids")).select(
        *keep,
        F.when(F.col("_ids").isNotNull(), F.size("_ids")).alias("n_ids"),
        F.transform(F.slice("_ids", 1, sample), typed.text_of).alias("first_ids"),
        F.when(F.col("_ids").isNull(), F.substring(F.col(body), 1, preview)).alias("preview"),
    )
