"""Batch plans, attempt outcomes and what got lost on the way, as tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordlake.functions import plain
from recordlake.functions.typed import typed_json
from recordlake.operators.unwrap import item_count
from recordlake.schema import BATCH_SIZE, CONCURRENCY, MAX_RETRIES, RETRY_BACKOFF
from recordlake.session import pin

# monotonically_increasing_id: partition number above, row number in the low 33 bits.
_ROW_BITS = (1 << 33) - 1

# Room for the record count of one attempt below the attempt number.
_COUNT_BITS = 40


def with_positions(df: DataFrame, order_by: Sequence[str], name: str = "pos") -> DataFrame:
    """Add the 0-based position of each row in a total order, without one global task.

    Rows are range-partitioned, sorted inside each partition and pinned in the shared
    folder. A position is the row's number in its partition plus the sizes of the
    partitions ahead; only those sizes, one row per partition, are broadcast. The scan
    order of the input breaks ties, so copies of one key spread over many ranges.
    """
    tied = df.withColumn("_tie", F.monotonically_increasing_id())
    keys = [*order_by, "_tie"]
    pinned = pin(tied.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie"))
    placed = pinned.select(
        "*",
        F.spark_partition_id().alias("_part"),
        F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS)).alias("_row"),
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    )
    return placed.join(F.broadcast(offsets), "_part").select(
        *df.columns, (F.col("_offset") + F.col("_row")).alias(name)
    )


def plan_batches(
    ids: DataFrame,
    order_by: Sequence[str],
    batch_size: int = BATCH_SIZE,
    concurrency: int = CONCURRENCY,
) -> DataFrame:
    """Slice an ordered id list into batches and groups of batches sent together."""
    placed = with_positions(ids, order_by)
    return placed.withColumn("batch_idx", F.expr(f"pos div {batch_size}")).withColumn(
        "group_idx", F.expr(f"batch_idx div {concurrency}")
    )


def batch_lists(plan: DataFrame, id_column: str) -> DataFrame:
    """One row per batch with its ids in order; a batch never exceeds the batch size."""
    members = F.array_sort(F.collect_list(F.struct("pos", id_column)))
    return (
        plan.groupBy("group_idx", "batch_idx")
        .agg(members.alias("_m"))
        .select("group_idx", "batch_idx", F.col(f"_m.{id_column}").alias("ids"))
    )


def backoff_seconds(attempt: Column, backoff: float = RETRY_BACKOFF) -> Column:
    """Wait ahead of an attempt: none before the first, then doubling."""
    return F.when(attempt > 0, F.lit(backoff) * F.pow(F.lit(2.0), attempt - 1)).otherwise(
        F.lit(0.0)
    )


def attempt_outcomes(attempts: DataFrame) -> DataFrame:
    """Classify attempts (status, error, body): outcome, records, wait and whether it stops.

    Attempts without records keep the start of the body as a preview.
    """
    body = F.coalesce(F.col("body"), F.lit(""))
    # A variant answers for most bodies; what it does not take goes through the strict step.
    variant = F.col("_variant")
    opened = attempts.withColumn("_variant", plain.opened(body)).withColumn(
        "_n", F.when(plain.is_value(body, variant), plain.item_count(variant))
    )
    parsed = opened.drop("_variant").withColumn("_typed", typed_json(F.when(F.col("_n").isNull(), body)))
    counted = parsed.withColumn("n_records", F.coalesce("_n", item_count(F.col("_typed"))))
    outcome = (
        F.when(F.col("error").isNotNull() & F.col("status").isNull(), "network_error")
        .when(F.col("status") == 500, "server_error")
        .when(F.col("_typed").isNull() & F.col("_n").isNull(), "parse_error")
        .when(F.col("n_records") > 0, "success")
        .otherwise("empty")
    )
    classed = counted.withColumn("outcome", outcome)
    stops = F.col("outcome").isin("success", "empty")
    return (
        classed.withColumn("n_records", F.when(F.col("outcome") == "success", F.col("n_records")).otherwise(0))
        .withColumn("wait_seconds", backoff_seconds(F.col("attempt")))
        .withColumn("stops", stops)
        .drop("_typed", "_n")
        .withColumn(
            "preview",
            F.when(F.col("outcome") == "parse_error", F.substring(body, 1, 100)).when(
                F.col("outcome").isin("server_error", "empty"), F.substring(body, 1, 120)
            ),
        )
    )


def batch_status(
    outcomes: DataFrame,
    key: str = "batch_idx",
    max_retries: int = MAX_RETRIES,
    backoff: float = RETRY_BACKOFF,
) -> DataFrame:
    """Final state of each batch: the stopping attempt's outcome, else FAILED.

    Attempts after the stopping one, or beyond the retry limit, do not count; a batch with
    nothing but such attempts has failed after its last allowed one. Attempt and record count
    of a stop travel as one number, so that a hash aggregate can combine them; a stop without
    records is an empty one.
    """
    allowed = F.col("attempt") <= max_retries
    packed = F.shiftleft(F.col("attempt").cast("bigint"), _COUNT_BITS).bitwiseOR(
        F.col("n_records").cast("bigint")
    )
    reduced = outcomes.groupBy(key).agg(
        F.min(F.when(F.col("stops") & allowed, packed)).alias("stop"),
        F.max(F.least("attempt", F.lit(max_retries))).alias("last"),
    )
    n_records = F.coalesce(F.col("stop").bitwiseAND(F.lit((1 << _COUNT_BITS) - 1)), F.lit(0))
    retries = F.coalesce(F.shiftright("stop", _COUNT_BITS), F.col("last"))
    return reduced.select(
        key,
        F.when(F.col("stop").isNull(), "FAILED")
        .when(n_records > 0, "success")
        .otherwise("empty")
        .alias("final_status"),
        (retries + 1).alias("attempts_made"),
        n_records.alias("n_records"),
        (F.lit(backoff) * (F.pow(F.lit(2.0), retries) - 1)).alias("wait_seconds"),
    )


def lost_ids(plan: DataFrame, status: DataFrame, key: str = "batch_idx") -> DataFrame:
    """All planned ids whose batch failed for good."""
    return plan.join(status.where(F.col("final_status") == "FAILED").select(key), key, "left_semi")


def coverage(locations: DataFrame, records: DataFrame, key: str = "id") -> DataFrame:
    """Each listed id with the number of records that came back for it.

    Both sides are reduced to one row per id first, so no id pairs up with itself.
    """
    listed = locations.select(key).distinct()
    returned = records.groupBy(key).agg(F.count(F.lit(1)).alias("n_returned"))
    return listed.join(returned, key, "left").select(
        key, F.coalesce("n_returned", F.lit(0)).alias("n_returned")
    )


def coverage_gap(locations: DataFrame, records: DataFrame, key: str = "id") -> DataFrame:
    """Listed ids for which no record came back."""
    return locations.select(key).distinct().join(
        records.select(key).distinct(), key, "left_anti"
    )


def lookup_details(locations: DataFrame, records: DataFrame, key: str = "id") -> DataFrame:
    """Records of listed ids; listed ids without a record stay, with nulls.

    Whole records are read and moved once, in a semi join, whose record side adaptive
    execution can split at a hot id (the optional side of an outer join it cannot). Which
    listed ids have a record comes from the key column alone, reduced before its shuffle.
    """
    listed = locations.select(F.col(key).alias("_listed")).distinct()
    present = records.select(F.col(key).alias("_present")).distinct()
    gap = listed.join(present, F.col("_listed") == F.col("_present"), "left_anti")
    found = records.join(listed, F.col(key) == F.col("_listed"), "left_semi")
    return found.unionByName(gap.select(F.col("_listed").alias(key)), allowMissingColumns=True)
