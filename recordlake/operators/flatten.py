"""From nested records to flat string rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordlake.functions.jsontext import first_default, joined_field
from recordlake.functions.typed import clean_text_of, joined_items
from recordlake.schema import (
    FREE_FORM_FIELDS,
    OUTPUT_COLUMNS,
    PROGRAM_LEVEL_FIELDS,
    SCALAR_FIELDS,
)
from recordlake.session import built_once, scratch_path


# Output columns that are one cleaned scalar each; the rest is joined from lists.
JOINED_COLUMNS = ["businessType_codes", "businessType_names", *FREE_FORM_FIELDS]
LEAF_COLUMNS = [c for c in OUTPUT_COLUMNS if c not in JOINED_COLUMNS]


@built_once
def leaf_values(record: str) -> Column:
    """The scalars of a record as typed text, in the order of ``LEAF_COLUMNS``."""
    rec = F.col(record)
    details, level = rec["partnerDetails"], F.get(rec["programLevels"], F.lit(0))
    at = {f: rec[f] for f in SCALAR_FIELDS}
    at |= {f: details[f] for f in ("firstName", "lastName", "about")}
    at |= {f"contact_{f}": details["partnerContact"][f] for f in ("email", "phone")}
    at |= {name: level[field] for name, field in PROGRAM_LEVEL_FIELDS.items()}
    descriptions = F.from_json(details["descriptions"], "array<struct<description:string,isDefault:string>>")
    at["description"] = first_default(descriptions)
    return F.array(*[at[c] for c in LEAF_COLUMNS])


@built_once
def flat_columns(record: str) -> dict[str, Column]:
    """Every output column, given a parsed record, its cleaned leaves and its opened types."""
    rec, types = F.col(record), F.col("_types")
    out = {c: F.get("_leaves", F.lit(i)) for i, c in enumerate(LEAF_COLUMNS)}
    out["businessType_codes"] = joined_field(types, rec["businessType"], "code")
    out["businessType_names"] = joined_field(types, rec["businessType"], "name")
    for f in FREE_FORM_FIELDS:
        out[f] = joined_items(rec[f])
    return out


def flatten_records(records: DataFrame, keep: Sequence[str] = (), rec: str = "rec") -> DataFrame:
    """The 39 string columns in output order, after any kept columns.

    All scalars go through one rule in one expression: repeated for every column it would
    make generated code too long for the JVM to compile.
    """
    flat = flat_columns(rec)
    types = F.from_json(F.col(rec)["businessType"], "array<struct<code:string,name:string>>")
    leaves = F.transform(leaf_values(rec), clean_text_of)
    opened = records.select(*keep, rec, leaves.alias("_leaves"), types.alias("_types"))
    return opened.select(*keep, *[flat[c].alias(c) for c in OUTPUT_COLUMNS])


def order_columns(df: DataFrame) -> DataFrame:
    """Known columns in output order, then unknown ones in the order they stand."""
    known = [c for c in OUTPUT_COLUMNS if c in df.columns]
    extras = [c for c in df.columns if c not in OUTPUT_COLUMNS]
    return df.select(*known, *extras)


def empty_columns(df: DataFrame) -> list[str]:
    """Columns without one non-blank value, found in a single pass over the rows."""
    flags = df.agg(*[F.max(F.col(c) != "").alias(c) for c in df.columns]).first()
    return [c for c in df.columns if not flags[c]]


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Leave out columns blank in every row.

    The table is stored in the shared folder first, so that the rows are made once: one
    aggregate over the stored columns tells which to keep, the result reads those.
    """
    path = scratch_path(df.sparkSession, "columns")
    df.write.parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    return stored.drop(*empty_columns(stored))
