"""Rules for the nested parts of a record, over typed text (see ``typed``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from recordlake.functions.text import strip_ws
from recordlake.functions.typed import is_truthy, text_of


def _all_plain(text: Column) -> Column:
    """True when a list's text shows no mark, no container inside its objects, and no string
    that could begin or end with white space: then its values are their own text."""
    marked = F.contains(text, F.lit("\\"))
    nested = F.contains(text, F.lit(":[")) | F.contains(text, F.lit(":{"))
    padded = F.contains(text, F.lit('" ')) | F.contains(text, F.lit(' "'))
    return ~(marked | nested | padded) & (F.octet_length(text) == F.length(text))


def joined_field(items: Column, text: Column, field: str) -> Column:
    """Truthy values of one field over parsed items, stripped and joined by ``"; "``.

    ``text`` is the JSON the items came from; the usual case stays free of lambdas.
    """
    values = items[field]
    exact = F.transform(F.filter(values, is_truthy), lambda t: strip_ws(text_of(t)))
    joined = F.when(_all_plain(text), F.array_join(F.array_remove(values, ""), "; ")).otherwise(
        F.array_join(exact, "; ")
    )
    return F.coalesce(joined, F.lit(""))


def first_default(items: Column) -> Column:
    """First truthy description (typed text) of an item whose isDefault is truthy; null if none."""
    wanted = F.filter(items, lambda d: is_truthy(d["description"]) & is_truthy(d["isDefault"]))
    return F.get(wanted, F.lit(0))["description"]
