"""Differences between runs, normalisation and pass/fail checks on a record table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordlake.functions.text import blank_if_null, is_filled, is_number, strip_ws
from recordlake.operators.dedupe import first_by
from recordlake.schema import PII_COLUMNS


def snapshot_delta(
    previous: DataFrame,
    current: DataFrame,
    order_by: Sequence[Column | str],
    columns: Sequence[str],
    key: str = "id",
) -> DataFrame:
    """Ids that are new, removed or changed in any column, with the changed columns.

    Ids may repeat within a run, so each side first keeps its first row per id.
    """
    columns = [c for c in columns if c != key]

    def side(df: DataFrame, name: str) -> DataFrame:
        row = F.struct(*columns).alias(name)
        return first_by(df, [key], order_by).select(F.col(key).alias(f"{name}_key"), row)

    # A null id is an id like any other.
    same = F.col("_old_key").eqNullSafe(F.col("_new_key"))
    both = side(previous, "_old").join(side(current, "_new"), same, "full_outer").withColumn(
        key, F.coalesce("_old_key", "_new_key")
    )
    changed = F.filter(
        F.array(
            *[
                F.when(~F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}")), F.lit(c))
                for c in columns
            ]
        ),
        lambda c: c.isNotNull(),
    )
    kind = (
        F.when(F.col("_old").isNull(), "new")
        .when(F.col("_new").isNull(), "removed")
        .when(F.size("_changed") > 0, "changed")
    )
    return (
        both.select(key, "_old", "_new", changed.alias("_changed"))
        .select(
            key,
            kind.alias("change"),
            F.when(kind == "changed", F.col("_changed")).alias("changed_columns"),
        )
        .where(F.col("change").isNotNull())
    )


def apply_aliases(df: DataFrame, column: str, aliases: Mapping[str, str]) -> DataFrame:
    """Replace stripped values by their alias; values without one are only stripped."""
    value = strip_ws(blank_if_null(F.col(column)))
    pairs = [F.lit(x) for pair in aliases.items() for x in pair]
    return df.withColumn(
        column, F.coalesce(F.try_element_at(F.create_map(*pairs), value), value)
    )


def join_aliases(df: DataFrame, column: str, aliases: DataFrame) -> DataFrame:
    """As ``apply_aliases`` with an alias table (alias, name) of any size."""
    known = first_by(aliases, ["alias"], ["name"]).select(
        F.col("alias").alias("_alias"), F.col("name").alias("_alias_name")
    )
    stripped = df.withColumn(column, strip_ws(blank_if_null(F.col(column))))
    named = stripped.join(known, F.col(column) == F.col("_alias"), "left")
    return named.withColumn(column, F.coalesce("_alias_name", column)).select(*df.columns)


def null_island_to_null(df: DataFrame) -> DataFrame:
    """Coordinates (0, 0) stand for unknown and become null."""

    def is_zero(c: str) -> Column:
        return F.coalesce(F.when(is_number(F.col(c)), F.col(c).try_cast("double")) == 0, F.lit(False))

    unknown = is_zero("latitude") & is_zero("longitude")
    return df.withColumns(
        {c: F.when(~unknown, F.col(c)) for c in ("latitude", "longitude")}
    )


def threshold_checks(
    df: DataFrame, min_fill: Mapping[str, float], max_duplicate_ids: int = 0
) -> DataFrame:
    """Rules with measured value, limit and verdict, from one aggregate."""
    n = F.count(F.lit(1))
    measured = [
        F.coalesce(100.0 * F.count_if(is_filled(F.col(c))) / F.nullif(n, F.lit(0)), F.lit(0.0)).alias(
            f"_m{i}"
        )
        for i, c in enumerate(min_fill)
    ]
    duplicates = (F.count("id") - F.count_distinct("id")).cast("double").alias("_dup")
    rules = [
        F.struct(
            F.lit(f"{c}_fill_pct").alias("rule"), F.col(f"_m{i}").alias("measured"),
            F.lit(float(limit)).alias("limit"), (F.col(f"_m{i}") >= limit).alias("passed"),
        )
        for i, (c, limit) in enumerate(min_fill.items())
    ]
    rules.append(
        F.struct(
            F.lit("duplicate_ids").alias("rule"), F.col("_dup").alias("measured"),
            F.lit(float(max_duplicate_ids)).alias("limit"),
            (F.col("_dup") <= max_duplicate_ids).alias("passed"),
        )
    )
    return df.agg(*measured, duplicates).select(F.inline(F.array(*rules)))


def require(checks: DataFrame) -> None:
    """Raise with the failed rules, if any."""
    failed = [r.asDict() for r in checks.where(~F.col("passed")).collect()]
    if failed:
        raise ValueError(f"quality rules failed: {failed}")


def contract_checks(entries: DataFrame, keys: Sequence[str], min_rows: int, text: str = "entry") -> DataFrame:
    """Listing contract: required keys on every entry and more than ``min_rows`` entries."""
    present = F.json_object_keys(F.col(text))
    found = entries.agg(
        F.count(F.lit(1)).alias("_n"),
        *[
            F.count_if(F.coalesce(F.array_contains(present, k), F.lit(False))).alias(f"_k{i}")
            for i, k in enumerate(keys)
        ],
    )
    rules = [
        F.struct(
            F.lit(f"key_{k}").alias("rule"), F.col(f"_k{i}").alias("measured"),
            F.col("_n").alias("limit"), (F.col(f"_k{i}") == F.col("_n")).alias("passed"),
        )
        for i, k in enumerate(keys)
    ]
    rules.append(
        F.struct(
            F.lit("n_entries").alias("rule"), F.col("_n").alias("measured"),
            F.lit(min_rows).cast("bigint").alias("limit"), (F.col("_n") > min_rows).alias("passed"),
        )
    )
    return found.select(F.inline(F.array(*rules)))


def drop_pii(df: DataFrame, columns: Sequence[str] = tuple(PII_COLUMNS)) -> DataFrame:
    """Leave out the columns that name or reach a person."""
    return df.drop(*columns)
