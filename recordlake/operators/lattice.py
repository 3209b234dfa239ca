"""The schema that all responses share, merged path by path.

A response tells which kinds of value stand at which paths. Counts per path and kind form a
state that can be added to any other one, in any order, so states of old runs are stored and
merged without reading their responses again. From a state follow the kinds of a path, whether
a field is optional, and what an array holds.
"""

from __future__ import annotations

import json
from collections import Counter
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

KINDS = ["object", "array", "string", "bigint", "double", "boolean", "null"]
STATE = ["path", "parent", "kind"]
_KIND_OF = {dict: "object", list: "array", str: "string", int: "bigint", float: "double", bool: "boolean", type(None): "null"}
_FOUND = ArrayType(StructType([*(StructField(c, StringType()) for c in STATE), StructField("n", LongType())]))


def _step(key: str) -> str:
    return f".{key}" if key.isidentifier() and key.isascii() else f"[{json.dumps(key, ensure_ascii=False)}]"


def paths_of(text: str | None) -> list[tuple[str, str | None, str, int]]:
    """(path, path above, kind, times) of every value of a response; nothing if it is no JSON.

    Members are ``.key`` (``["other key"]``), items of an array ``[]``. Of repeated keys the
    last one counts.
    """
    try:
        value = json.loads(text)
    except (ValueError, TypeError, RecursionError):
        return []
    found, open_ = Counter(), [("$", None, value)]
    while open_:
        path, above, value = open_.pop()
        found[path, above, _KIND_OF[type(value)]] += 1
        if type(value) is dict:
            open_ += [(path + _step(k), path, v) for k, v in value.items()]
        elif type(value) is list:
            open_ += [(f"{path}[]", path, v) for v in value]
    return [(*place, n) for place, n in found.items()]


@F.arrow_udf(_FOUND)
def _paths(texts: pa.Array) -> pa.Array:
    rows = [[dict(zip([*STATE, "n"], p)) for p in paths_of(t)] for t in texts.to_pylist()]
    kind = pa.list_(pa.struct([*((c, pa.string()) for c in STATE), ("n", pa.int64())]))
    try:
        return pa.array(rows, kind)
    except UnicodeEncodeError:  # half of a surrogate pair in a key: no character
        return pa.array([[{k: v.encode("utf-8", "replace").decode() if type(v) is str else v for k, v in p.items()} for p in r] for r in rows], kind)


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*STATE).agg(F.sum("n").alias("n"))


def shape_state(df: DataFrame, body: str = "body") -> DataFrame:
    """(path, parent, kind, n) over all responses; added up in every task before the shuffle."""
    return _summed(df.select(F.inline(_paths(F.col(body)))))


def merge_states(*states: DataFrame) -> DataFrame:
    """The state of all responses that went into the given ones."""
    return _summed(reduce(DataFrame.unionByName, states))


def merged_schema(state: DataFrame) -> DataFrame:
    """One row per path: kinds joined by ``|``, counts per kind, and whether it is optional.

    A member is optional if some object at the path above lacks it; items of an array and the
    root are not. ``kinds`` leaves null out; ``nullable`` says that it occurs.
    """
    by_path = state.groupBy("path", "parent").agg(
        F.sum("n").alias("n_values"),
        *[F.sum(F.when(F.col("kind") == k, F.col("n")).otherwise(0)).alias(f"n_{k}") for k in KINDS],
    )
    objects = by_path.select(F.col("path").alias("_above"), F.col("n_object").alias("_objects"))
    member = ~F.endswith("path", F.lit("[]")) & F.col("parent").isNotNull()
    kinds = F.concat_ws("|", *[F.when(F.col(f"n_{k}") > 0, F.lit(k)) for k in KINDS if k != "null"])
    return by_path.join(objects, F.col("parent") == F.col("_above"), "left").select(
        "path", kinds.alias("kinds"), (F.col("n_null") > 0).alias("nullable"),
        (member & (F.col("n_values") < F.coalesce("_objects", F.lit(0)))).alias("optional"),
        "n_values", *[f"n_{k}" for k in KINDS],
    )
