"""Complete runs: raw lines to record table, rejects, CSV, quality reports and fetch audit."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordlake.operators import audit, profile
from recordlake.operators.dedupe import digest, fingerprint, first_and_count, first_wins
from recordlake.operators.flatten import flatten_records
from recordlake.operators.unwrap import explode_all, explode_records, malformed_records
from recordlake.schema import OUTPUT_COLUMNS
from recordlake.sources import sinks
from recordlake.sources.raw import ARRIVAL, read_attempts, read_locations, read_raw

log = logging.getLogger(__name__)

ORDER = [*ARRIVAL, "pos"]


@dataclass
class RunResult:
    """Counts and tables of a run; every count is taken from stored files."""

    parsed: int
    unique: int
    rejected: int = 0
    table: DataFrame | None = None
    rejects: DataFrame | None = None
    reports: dict[str, DataFrame] = field(default_factory=dict)


def unique_records(raw: DataFrame, order_by: Sequence[str] = ORDER) -> DataFrame:
    """Raw lines to flat, first-wins records; the arrival columns stay for ordering."""
    keep = [c for c in order_by if c != "pos"]
    flat = flatten_records(explode_records(raw, keep), [*keep, "pos"])
    return first_wins(flat, order_by)


def arrivals(raw: DataFrame) -> DataFrame:
    """Flat records and unparsable lines (``rejected``), with the arrival columns."""
    rows = explode_all(raw, ARRIVAL).withColumn("pos", F.coalesce("pos", F.lit(0)))
    return flatten_records(rows, [*ORDER, "rejected"])


def arrival_key() -> Column:
    """Fingerprint of a record; an unparsable line is a key of its own."""
    place = F.concat_ws("|", *ORDER)
    return digest(F.when(F.col("rejected").isNull(), F.concat(F.lit("r"), fingerprint())).otherwise(
        F.concat(F.lit("x"), place)
    ))


def first_arrivals(rows: DataFrame, copies: Column | None = None) -> DataFrame:
    """The first arrival of each record with its number of copies; unparsable lines stay."""
    return first_and_count(rows, arrival_key(), ORDER, copies)


def combine_configs(configs: Mapping[str, DataFrame], column: str = "config_id") -> DataFrame:
    """Several sources as one table with the configuration each row came from."""
    parts = [df.withColumn(column, F.lit(name)) for name, df in configs.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def quality_reports(table: DataFrame, ordered: DataFrame, order_by: Sequence[str]) -> dict[str, DataFrame]:
    """The reports that apply to the columns at hand."""
    reports = {
        "summary": profile.quality_summary(table),
        "fill_rates": profile.fill_rates(table),
        "sample": profile.sample_rows(ordered, order_by),
    }
    if "country" in table.columns:
        reports["countries"] = profile.value_counts(table, "country")
    if "businessType_names" in table.columns:
        reports["business_types"] = profile.exploded_counts(table, "businessType_names")
    return reports


def fetch_audit(records: DataFrame, locations: DataFrame, attempts: DataFrame | None = None) -> dict[str, DataFrame]:
    """What a run should have brought and did not.

    ``coverage`` counts the records of each listed id, ``missing`` are ids without any. With
    an attempt log (batch_idx, attempt, status, error, body) also ``batch_status`` and
    ``lost_ids``, the planned ids of batches that failed for good.
    """
    found = records.select(F.col("id").try_cast("bigint").alias("id"))
    listed = locations.select("id").where("id IS NOT NULL")
    tables = {"coverage": audit.coverage(listed, found), "missing": audit.coverage_gap(listed, found)}
    if attempts is not None:
        status = audit.batch_status(audit.attempt_outcomes(attempts))
        plan = audit.plan_batches(locations.select("id"), ["id"])
        tables |= {"batch_status": status, "lost_ids": audit.lost_ids(plan, status)}
    return tables


def finish(
    spark: SparkSession,
    first: DataFrame,
    out_dir: str,
    run_ts: str,
    formats: Sequence[str] = ("csv",),
    drop_empty: bool = True,
    locations: DataFrame | None = None,
    attempts: DataFrame | None = None,
) -> RunResult:
    """Store first arrivals, then count, export, report and audit from what was stored.

    Counts come from the stored rows: they stay right when tasks are repeated after an
    executor was lost.
    """
    stored = sinks.run_path(out_dir, "records", run_ts)
    first.write.parquet(stored)
    everything = spark.read.parquet(stored)
    is_record = F.col("rejected").isNull()
    filled = [F.max(is_record & (F.col(c) != "")).alias(c) for c in OUTPUT_COLUMNS]
    counted = everything.agg(
        F.sum(F.when(is_record, F.col("copies"))).alias("_parsed"), F.count_if(is_record).alias("_unique"),
        F.count_if(~is_record).alias("_rejected"), *filled,
    ).first()
    result = RunResult(counted["_parsed"] or 0, counted["_unique"], counted["_rejected"])
    result.rejects = everything.where(~is_record).select(*ARRIVAL, F.col("rejected").alias("line"))
    log.info("records parsed: %d, unique: %d, lines rejected: %d", result.parsed, result.unique, result.rejected)
    ordered = everything.where(is_record)
    if locations is not None:
        result.reports |= fetch_audit(ordered, locations, attempts)
        if attempts is not None:
            sinks.write_failed_ids(result.reports["lost_ids"], sinks.run_path(out_dir, "lost_ids", run_ts))
    if result.unique == 0:
        log.error("no records in %s: no export and no report written", stored)
        return result
    columns = [c for c in OUTPUT_COLUMNS if counted[c] or not drop_empty]
    table = ordered.select(*columns)
    for fmt in formats:
        path = sinks.run_path(out_dir, f"export_{fmt}", run_ts)
        if fmt == "csv":
            sinks.export_csv(ordered.select(*ORDER, *columns), path, ORDER)
        else:
            sinks.write_table(table, path, fmt)
    result.table = table
    result.reports |= quality_reports(table, ordered, ORDER)
    return result


def run_batch(
    spark: SparkSession,
    raw_path: str,
    out_dir: str,
    run_ts: str,
    formats: Sequence[str] = ("csv",),
    backup: bool = True,
    drop_empty: bool = True,
    quarantine: bool = False,
    listing_path: str | None = None,
    attempts_path: str | None = None,
) -> RunResult:
    """Unwrap, flatten, de-duplicate, store, export, profile and audit.

    Records, copies and unparsable lines are written once as Parquet, from one pass over the
    JSON; everything after it reads the columnar table. ``quarantine`` also stores records
    with malformed nested fields, which reads the lines again. With a listing, and if
    available the log of fetch attempts, the result also tells what is missing.
    """
    raw = read_raw(spark, raw_path)
    if backup:
        sinks.write_raw(raw, sinks.run_path(out_dir, "raw", run_ts))
    if quarantine:
        malformed_records(raw, ARRIVAL).write.parquet(sinks.run_path(out_dir, "quarantine", run_ts))
    locations = read_locations(spark, listing_path) if listing_path else None
    attempts = read_attempts(spark, attempts_path) if attempts_path else None
    return finish(
        spark, first_arrivals(arrivals(raw)), out_dir, run_ts, formats, drop_empty, locations, attempts
    )
