"""Merged schemas against a walk over Python values."""

import json
import random

from pyspark.sql import functions as F

from recordlake.operators import lattice

KEYS = ["id", "name", "a b", "é", "x.y"]


def value(rng, depth=0):
    kind = rng.randrange(8 if depth < 4 else 6)
    if kind < 6:
        return rng.choice([None, True, 3, 2.5, "t", ""])
    if kind == 6:
        return [value(rng, depth + 1) for _ in range(rng.randrange(4))]
    return {k: value(rng, depth + 1) for k in rng.sample(KEYS, rng.randrange(5))}


def walk(v, path="$", above=None):
    yield path, above, {dict: "object", list: "array", str: "string", int: "bigint", float: "double", bool: "boolean"}.get(type(v), "null")
    if isinstance(v, dict):
        for k, x in v.items():
            yield from walk(x, path + (f".{k}" if k in ("id", "name") else f'["{k}"]'), path)
    elif isinstance(v, list):
        for x in v:
            yield from walk(x, path + "[]", path)


def test_schema_equals_a_walk(spark):
    rng = random.Random(3)
    values = [value(rng) for _ in range(300)]
    texts = [json.dumps(v, ensure_ascii=rng.random() < 0.5) for v in values] + ["no json", "", None, "[1,]"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, body string").repartition(4)
    got = {r.path: r for r in lattice.merged_schema(lattice.shape_state(df)).collect()}
    want = {}
    for v in values:
        for path, above, kind in walk(v):
            want.setdefault((path, above), []).append(kind)
    objects = {path: kinds.count("object") for (path, _), kinds in want.items()}
    assert got.keys() == {p for p, _ in want} and len(got) > 50
    for (path, above), kinds in want.items():
        row = got[path]
        assert row.n_values == len(kinds) and all(row[f"n_{k}"] == kinds.count(k) for k in lattice.KINDS)
        assert row.kinds == "|".join(k for k in lattice.KINDS if k in kinds and k != "null") and row.nullable == ("null" in kinds)
        member = above is not None and not path.endswith("[]")
        assert row.optional == (member and len(kinds) < objects[above])


def test_states_merge_in_any_order(spark):
    rng = random.Random(9)
    df = spark.createDataFrame([(i, json.dumps(value(rng))) for i in range(90)], "i int, body string")
    parts = [lattice.shape_state(df.where(F.col("i") % 3 == k)) for k in range(3)]
    whole = sorted(map(str, lattice.shape_state(df).collect()))
    assert sorted(map(str, lattice.merge_states(*parts).collect())) == whole
    assert sorted(map(str, lattice.merge_states(parts[2], lattice.merge_states(parts[1], parts[0])).collect())) == whole
    assert lattice.merged_schema(lattice.shape_state(df.where("false"))).collect() == []


def test_odd_texts(spark):
    assert lattice.paths_of('{"a":1,"a":"x"}') == [("$", None, "object", 1), ("$.a", "$", "string", 1)]
    assert lattice.paths_of("[" * 100000) == []
    odd = spark.createDataFrame([('{"\\ud800":1}',), ("NaN",)], "body string")
    assert {r.kind for r in lattice.shape_state(odd).collect()} == {"object", "bigint", "double"}
