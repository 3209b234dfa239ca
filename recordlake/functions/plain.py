"""Shape of JSON texts read by the JVM as VARIANT, for questions that need no values.

A variant tells whether a text is one JSON value and how many items its record list has. It
refuses repeated keys and everything that is no JSON; what it refuses is left to the strict
step (see ``typed``), so that the answers are the same. Values are not taken from variants:
they do not keep the text of numbers nor the order of keys.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from recordlake.schema import LIST_KEYS, SINGLE_KEYS

# What follows the text in the list that is parsed: it must come right after one value.
_END = "#end#"


def opened(text: Column) -> Column:
    """The variant that the functions below take: a list of the text's value and an end mark.

    Null for every text, so that all are read strictly, in a session that lets variants have
    repeated keys.
    """
    lenient = SparkSession.active().conf.get("spark.sql.variant.allowDuplicateKeys", "false") == "true"
    read = F.try_parse_json(F.concat(F.lit("["), text, F.lit(f',"{_END}"]')))
    return F.lit(None).cast("variant") if lenient else read


def is_value(text: Column, variant: Column) -> Column:
    """True if the text is one JSON value without repeated keys; false may still be JSON."""
    ended = F.try_variant_get(variant, "$[1]", "string") == _END
    return F.coalesce(ended & ~F.contains(text, F.lit(_END)), F.lit(False))


def has(variant: Column, path: str) -> Column:
    """True if there is a value at the path, even a null one."""
    return F.try_variant_get(variant, path, "variant").isNotNull()


def item_count(variant: Column, root: str = "$[0]") -> Column:
    """Number of items, objects or not, in the record list of the value at ``root``."""

    def size(path: str) -> Column:
        return F.size(F.try_variant_get(variant, path, "array<variant>"))

    chosen = F.when(has(variant, f"{root}[0]"), size(root))
    for k in LIST_KEYS:
        chosen = chosen.when(has(variant, f"{root}.{k}[0]"), size(f"{root}.{k}"))
    for k in SINGLE_KEYS:
        chosen = chosen.when(has(variant, f"{root}.{k}"), F.lit(1))
    return chosen.otherwise(F.lit(0))


def body_count(variant: Column) -> Column:
    """The same for a raw line: of its ``body``, or of the whole line if it has no such key."""
    return F.when(has(variant, "$[0].body"), item_count(variant, "$[0].body")).otherwise(item_count(variant))
