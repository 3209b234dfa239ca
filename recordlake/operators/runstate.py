"""Counts over many runs from a small stored state per run.

A run's state is one row: its rows, the filled values of its columns, and a theta sketch of
its ids. States are merged without reading the runs again. A sketch counts distinct ids
exactly up to its size and within a known error beyond it; where that is not enough the ids of
the stored runs are counted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlake.functions.text import is_filled
from recordlake.operators.dedupe import digest

# Sketches keep this power of two of hashes: distinct ids up to it are counted exactly, and
# more with a relative standard error of one in 256 (8 bytes per hash kept).
LG_SIZE = 16


def run_state(records: DataFrame, run: str, columns: Sequence[str] = (), key: str = "id", lg_size: int = LG_SIZE) -> DataFrame:
    """(run, n_rows, n_ids, ids, filled): one row, also for a run without records.

    ``n_ids`` counts rows with an id, ``ids`` is the sketch of their ids as text, ``filled``
    maps each column to its filled values.
    """
    filled = [x for c in columns for x in (F.lit(c), F.coalesce(F.count_if(is_filled(F.col(c))), F.lit(0)))]
    return records.agg(
        F.lit(run).alias("run"), F.count(F.lit(1)).alias("n_rows"), F.count(key).alias("n_ids"),
        F.theta_sketch_agg(F.col(key).cast("string"), lg_size).alias("ids"),
        (F.create_map(*filled) if filled else F.create_map().cast("map<string,bigint>")).alias("filled"),
    )


def over_runs(states: DataFrame, lg_size: int = LG_SIZE) -> DataFrame:
    """One row over all states: n_runs, n_rows, distinct_ids, duplicate_ids, exact, error.

    ``exact`` tells that the sketch never had to leave out a hash; otherwise ``error`` is two
    relative standard errors of ``distinct_ids``, as a number of ids. A state that is there
    twice counts once.
    """
    once = states.dropDuplicates(["run"])
    merged = once.agg(
        F.count(F.lit(1)).alias("n_runs"), F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum("n_ids"), F.lit(0)).alias("_n_ids"),
        F.coalesce(F.theta_sketch_estimate(F.theta_union_agg("ids", lg_size)), F.lit(0)).cast("long").alias("distinct_ids"),
    )
    exact = F.col("distinct_ids") <= 2**lg_size
    error = F.when(exact, 0).otherwise(F.ceil(F.col("distinct_ids") * F.lit(2 / (2**lg_size - 1) ** 0.5)))
    return merged.select(
        "n_runs", "n_rows", "distinct_ids", (F.col("_n_ids") - F.col("distinct_ids")).alias("duplicate_ids"),
        exact.alias("exact"), error.cast("long").alias("error"),
    )


def fill_over_runs(states: DataFrame) -> DataFrame:
    """(column, filled, n_rows) over all states; a run without a column has none of it filled."""
    once = states.dropDuplicates(["run"])
    total = once.agg(F.sum("n_rows")).first()[0] or 0
    entries = once.select(F.explode("filled").alias("column", "n"))
    return entries.groupBy("column").agg(F.sum("n").alias("filled")).withColumn("n_rows", F.lit(total).cast("long"))


def exact_over_runs(runs: Sequence[DataFrame], key: str = "id") -> DataFrame:
    """(distinct_ids, duplicate_ids) of the runs themselves, where a state is not exact enough.

    Every run sends an id once per task, as a digest.
    """
    ids = None
    for df in runs:
        own = df.where(F.col(key).isNotNull()).select(digest(F.col(key).cast("string")).alias("_id"))
        counted = own.groupBy("_id").agg(F.count(F.lit(1)).alias("n"))
        ids = counted if ids is None else ids.unionByName(counted)
    per_id = ids.groupBy("_id").agg(F.sum("n").alias("n"))
    return per_id.agg(F.count(F.lit(1)).alias("distinct_ids"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_ids"))
