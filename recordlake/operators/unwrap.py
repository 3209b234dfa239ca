"""From raw response lines to one row per record.

A raw line is checked and read once by a strict parser (``typed_body``). Its first character
tells a list from an object; in an object the list key is chosen from its fields; the chosen
list is parsed once into records. No record depends on its neighbours in the line.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordlake.functions import plain, typed
from recordlake.functions.text import let
from recordlake.functions.typed import is_object, is_truthy, typed_body
from recordlake.schema import FREE_FORM_FIELDS, LIST_KEYS, RECORD_DDL, SINGLE_KEYS
from recordlake.session import built_once


def list_text(body: Column) -> Column:
    """Typed text of the record list in a body (typed text); null when the body has none."""

    def chosen(m: Column) -> Column:
        filled = [
            F.when(typed.is_list(m[k]) & (m[k] != "[]"), m[k]) for k in LIST_KEYS
        ]
        single = F.arrays_overlap(F.map_keys(m), F.array(*[F.lit(k) for k in SINGLE_KEYS]))
        return F.coalesce(*filled, F.when(single, F.concat(F.lit("["), body, F.lit("]"))))

    inside = let(F.from_json(body, "map<string,string>"), chosen)
    return F.when(typed.is_list(body), body).when(is_object(body), inside)


def body_items(body: Column) -> Column:
    """Items of the record list of a typed body, whatever their type; empty when none."""
    return F.coalesce(typed.items(list_text(body)), F.array().cast("array<string>"))


def item_count(body: Column) -> Column:
    """Number of items that a typed response body holds, objects or not."""
    return F.coalesce(F.size(F.from_json(list_text(body), "array<string>")), F.lit(0))


@built_once
def record_list(column: str, ddl: str = RECORD_DDL) -> Column:
    """Records of a list's typed text as an array; an item that is no object is null.

    A list of objects is parsed in one go; a mixed one item by item, with the same result.
    """
    text = F.col(column)
    direct = F.from_json(text, f"array<{ddl}>")
    single = F.transform(
        F.from_json(text, "array<string>"), lambda t: F.when(is_object(t), F.from_json(t, ddl))
    )
    return F.coalesce(direct, single)


def explode_records(
    raw: DataFrame, keep: Sequence[str] = (), line: str = "value", ddl: str = RECORD_DDL
) -> DataFrame:
    """One row per object record: kept columns, ``pos`` in its list, ``rec``.

    ``ddl`` may name fewer fields, if only those are needed.
    """
    listed = raw.select(*keep, typed_body(F.col(line)).alias("_body")).select(
        *keep, list_text(F.col("_body")).alias("_list")
    )
    records = listed.select(*keep, F.posexplode(record_list("_list", ddl)).alias("pos", "rec"))
    return records.where(F.col("rec").isNotNull())


def explode_all(raw: DataFrame, keep: Sequence[str] = (), line: str = "value") -> DataFrame:
    """As ``explode_records``, and one row per line that cannot be parsed.

    Such a row has a null ``rec`` and its text in ``rejected``, which is null elsewhere; both
    come from one pass over the lines.
    """
    text = F.col(line)
    bodies = raw.select(*keep, text.alias("_line"), typed_body(text).alias("_body"))
    listed = bodies.select(
        *keep, F.when(F.col("_body").isNull(), F.col("_line")).alias("rejected"),
        list_text(F.col("_body")).alias("_list"),
    )
    rows = listed.select(*keep, "rejected", F.posexplode_outer(record_list("_list")).alias("pos", "rec"))
    return rows.where(F.col("rec").isNotNull() | F.col("rejected").isNotNull())


def rejected_lines(raw: DataFrame, keep: Sequence[str] = (), line: str = "value") -> DataFrame:
    """Lines that are not one complete JSON value: kept columns and the text.

    Only lines that VARIANT does not take go through the strict step.
    """
    text = F.col("line")
    read = raw.select(*keep, F.col(line).alias("line")).withColumn("_variant", plain.opened(text))
    open_ = read.select(*keep, "line", plain.is_value(text, F.col("_variant")).alias("_fine"))
    checked = open_.where(~F.col("_fine")).drop("_fine").withColumn("_body", typed_body(text))
    return checked.where(F.col("_body").isNull()).drop("_body")


def records_per_line(raw: DataFrame, keep: Sequence[str], line: str = "value") -> DataFrame:
    """Number of list items in each raw line, from its VARIANT where it has one."""
    text, variant = F.col("_line"), F.col("_variant")
    read = raw.select(*keep, F.col(line).alias("_line")).withColumn("_variant", plain.opened(text))
    quick = read.select(*keep, "_line", F.when(plain.is_value(text, variant), plain.body_count(variant)).alias("_n"))
    bodies = quick.select(*keep, "_n", typed_body(F.when(F.col("_n").isNull(), text)).alias("_body"))
    return bodies.select(*keep, F.coalesce("_n", item_count(F.col("_body"))).alias("n_records"))


def _malformed_fields(record: Column) -> Column:
    """Names of nested fields whose JSON type does not fit; falsy values fit everywhere."""
    names = ["partnerDetails", "businessType", "programLevels", *FREE_FORM_FIELDS]
    at = {n: F.from_json(record, ",".join(f"{x}:string" for x in names).join(["struct<", ">"]))[n] for n in names}
    inside = F.from_json(at["partnerDetails"], "partnerContact string, descriptions string")
    at["partnerDetails.partnerContact"] = inside["partnerContact"]
    at["partnerDetails.descriptions"] = inside["descriptions"]

    def objects(v: Column) -> Column:
        return F.forall(typed.items(v), is_object)

    fits = {p: is_object(at[p]) for p in ("partnerDetails", "partnerDetails.partnerContact")}
    fits |= {p: objects(at[p]) for p in ("partnerDetails.descriptions", "businessType")}
    fits["programLevels"] = is_object(F.get(typed.items(at["programLevels"]), F.lit(0)))
    fits |= {p: typed.is_list(at[p]) for p in FREE_FORM_FIELDS}
    named = [
        F.when(is_truthy(at[p]) & ~F.coalesce(ok, F.lit(False)), F.lit(p)) for p, ok in fits.items()
    ]
    return F.array_compact(F.array(*named))


def malformed_records(raw: DataFrame, keep: Sequence[str] = (), line: str = "value") -> DataFrame:
    """Quarantine: object records with a nested field of the wrong type.

    ``flatten_records`` leaves such a field blank; here are the record texts and the
    names of the fields concerned.
    """
    bodies = raw.select(*keep, typed_body(F.col(line)).alias("_body"))
    found = bodies.select(*keep, F.posexplode(body_items(F.col("_body"))).alias("pos", "_record"))
    checked = found.where(is_object(F.col("_record"))).withColumn("fields", _malformed_fields(F.col("_record")))
    return checked.where(F.size("fields") > 0).select(
        *keep, "pos", typed.compact_json(F.col("_record")).alias("record"), "fields"
    )
