"""Searching and profiling JSON of unknown shape."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordlake.functions import typed

# --- fixed values: keys whose presence marks a totals or id-list object ------------
TOTAL_KEYS = ["total", "totalCount", "count"]
DETAIL_KEYS = ["detail", "message", "code"]
ID_LIST_MARKS = ["total", "count", "ids", "partnerIds"]


def _texts(items: Column, sample: int) -> Column:
    return F.transform(F.slice(items, 1, sample), typed.text_of)


def named_arrays(
    df: DataFrame,
    body: str,
    name: str = "ids",
    min_size: int = 10,
    depth: int = 4,
    root: str = "$",
    sample: int = 5,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Arrays called ``name`` with more than ``min_size`` items, at most ``depth`` steps down.

    One pass over the input. Each step opens the containers found so far; a hit leaves as
    a finished row that later steps only pass on, and leaf values are dropped at once.
    """
    none = F.lit(None).cast("string")
    rows = df.select(
        *keep, F.lit(root).alias("path"), typed.typed_json(F.col(body)).alias("node"), none.alias("hit")
    )
    for _ in range(depth):
        inside = F.transform(
            F.filter(typed.entries(F.col("node")), lambda e: typed.is_container(e["value"])),
            lambda e: F.struct(
                F.concat_ws(".", "path", e["step"]).alias("path"), e["value"].alias("node"),
                F.when((e["step"] == name) & typed.is_list(e["value"]), e["value"]).alias("hit"),
            ),
        )
        # A hit goes on as a finished row, and once more as a container to be opened.
        split = F.flatten(F.transform(inside, lambda s: F.array(
            F.struct(s["path"].alias("path"), s["node"].alias("node"), none.alias("hit")),
            F.struct(s["path"].alias("path"), none.alias("node"), s["hit"].alias("hit")),
        )))
        done = F.array(F.struct("path", none.alias("node"), "hit"))
        kept = F.when(F.col("hit").isNotNull(), done).otherwise(
            F.filter(split, lambda s: s["node"].isNotNull() | s["hit"].isNotNull())
        )
        rows = rows.select(*keep, F.inline(kept))
    found = rows.where(F.col("hit").isNotNull()).select(*keep, "path", typed.items(F.col("hit")).alias("_items"))
    return found.where(F.size("_items") > min_size).select(
        *keep, "path", F.size("_items").alias("n_items"), _texts(F.col("_items"), sample).alias("sample")
    )


def _long_lists(entries: Column, min_size: int) -> Column:
    """Entries whose value is a list with more than ``min_size`` items, lists opened."""
    opened = F.transform(
        entries, lambda e: F.struct(e["step"].alias("path"), typed.items(e["value"]).alias("items"))
    )
    return F.filter(opened, lambda e: F.size(e["items"]) > min_size)


def _sampled(hit: Column, sample: int) -> Column:
    return F.struct(
        hit["path"].alias("path"), F.size(hit["items"]).alias("n_items"), _texts(hit["items"], sample).alias("sample")
    )


def id_list_keys(
    df: DataFrame, body: str, min_size: int = 50, sample: int = 5, keep: Sequence[str] = ()
) -> DataFrame:
    """Keys of an object whose value is a long list that starts with a whole number."""

    def starts_whole(e: Column) -> Column:
        return typed.kind(F.get(e["items"], F.lit(0))).isin("bigint", "boolean")

    top = df.select(*keep, typed.typed_json(F.col(body)).alias("_body"))
    entries = F.when(typed.is_object(F.col("_body")), typed.entries(F.col("_body")))
    lists = F.filter(_long_lists(entries, min_size), starts_whole)
    shown = F.transform(lists, lambda e: _sampled(e, sample))
    return top.select(*keep, F.inline(shown)).withColumnRenamed("path", "key")


def key_arrays(
    df: DataFrame, body: str, word: str = "countr", min_size: int = 10, sample: int = 5,
    keep: Sequence[str] = (),
) -> DataFrame:
    """For each document the first array, two levels down, whose key contains ``word``.

    First means document order: JSON maps keep their keys as they stand in the text. A
    document is searched inside its row.
    """
    top = df.select(*keep, typed.typed_json(F.col(body)).alias("_body"))
    outer = F.when(typed.is_object(F.col("_body")), typed.entries(F.col("_body")))
    objects = F.filter(outer, lambda e: typed.is_object(e["value"]))

    def inside(o: Column) -> Column:
        named = F.filter(typed.entries(o["value"]), lambda e: F.contains(F.lower(e["step"]), F.lit(word)))
        return F.transform(
            _long_lists(named, min_size),
            lambda e: F.struct(F.concat_ws(".", o["step"], e["path"]).alias("path"), e["items"].alias("items")),
        )

    found = top.select(*keep, F.get(F.flatten(F.transform(objects, inside)), F.lit(0)).alias("_hit"))
    hits = found.where(F.col("_hit").isNotNull())
    return hits.select(*keep, _sampled(F.col("_hit"), sample).alias("_s")).select(*keep, "_s.*")


def has_any_key(body: Column, names: Sequence[str] = tuple(ID_LIST_MARKS)) -> Column:
    """True when an object has at least one of the keys, whatever its value."""
    wanted = F.array(*[F.lit(k) for k in names])
    return F.coalesce(F.arrays_overlap(F.json_object_keys(body), wanted), F.lit(False))


def _first_present(m: Column, names: Sequence[str], default: Column | None = None) -> Column:
    """Text of the first key that is present; an explicit null ends the search as null.

    Without any of the keys an object gives ``default``.
    """
    chain = None
    for k in names:
        test, value = F.map_contains_key(m, k), typed.text_of(m[k])
        chain = F.when(test, value) if chain is None else chain.when(test, value)
    return chain if default is None else chain.when(m.isNotNull(), default)


def response_shapes(
    df: DataFrame, body: str = "body", keep: Sequence[str] = (), n_keys: int = 6, sample: int = 3
) -> DataFrame:
    """Shape of each response: kind, list length, first item kind, first keys, total, detail.

    Lists also show their first items and the keys of the first object.
    """
    text = F.col(body)
    opened = df.select(*keep, text.alias("_text"), typed.typed_json(text).alias("_typed")).select(
        *keep, "_text", "_typed", typed.fields(F.col("_typed")).alias("_fields"),
        typed.items(F.col("_typed")).alias("_items"),
    )
    listed, named = F.col("_items").isNotNull(), F.col("_fields").isNotNull()
    first = F.get("_items", F.lit(0))
    return opened.select(
        *keep,
        F.when(listed, "list").when(named, "object").otherwise("raw").alias("shape"),
        F.when(listed, F.size("_items")).alias("n_items"),
        F.when(listed & (F.size("_items") > 0), typed.kind(first)).alias("first_item"),
        F.slice(F.map_keys("_fields"), 1, n_keys).alias("first_keys"),
        _first_present(F.col("_fields"), TOTAL_KEYS).alias("total"),
        _first_present(F.col("_fields"), DETAIL_KEYS, F.substring("_text", 1, 80)).alias("detail"),
        F.when(~listed & ~named, F.substring("_text", 1, 100)).alias("preview"),
        F.transform(F.slice("_items", 1, sample), typed.json_of).alias("first_items"),
        F.map_keys(typed.fields(first)).alias("item_keys"),
    )


def shape_counts(shapes: DataFrame, by: Sequence[str] = ("shape", "status")) -> DataFrame:
    """Number of responses per shape and status."""
    return shapes.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
