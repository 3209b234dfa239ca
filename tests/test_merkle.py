"""Deltas of stored runs: the rows of a plain delta, from the ranges that differ."""

import random

import pytest
from pyspark.sql import functions as F

from recordlake.operators import delta, merkle

COLUMNS = ["a", "b"]


def stored(spark, tmp_path, name, rows, levels):
    df = spark.createDataFrame(rows, "id string, a string, b string")
    merkle.store_run(df, str(tmp_path / name), COLUMNS, COLUMNS, levels=levels)
    return df, str(tmp_path / name)


def key_of(r):
    return tuple(str(v) for v in r)


@pytest.mark.parametrize("levels", [1, 3])
def test_stored_delta_equals_the_plain_one(spark, tmp_path, levels):
    rng = random.Random(levels)
    base = [(str(i), rng.choice("xyz"), rng.choice([None, "", "q"])) for i in range(300)]
    base += [("7", "later", "row"), (None, "no", "id"), ("", "blank", "id")]
    # Values that move between columns, nulls against blanks, ids that go, come and repeat.
    changed = [(i, b, a) if i in ("5", "6") else (i, a, b or None) for i, a, b in base if i not in ("1", "2")]
    changed += [("900", "new", None), (None, "other", "id")]
    old, before = stored(spark, tmp_path, "old", base, levels)
    new, after = stored(spark, tmp_path, "new", changed, levels)
    want = delta.snapshot_delta(old, new, COLUMNS, COLUMNS)
    got = merkle.stored_delta(spark, before, after, COLUMNS)
    assert sorted(map(key_of, got.collect())) == sorted(map(key_of, want.collect())) and want.count() > 3


def test_rows_joined_follow_the_change(spark, tmp_path):
    base = [(str(i), f"a{i}", "b") for i in range(20000)]
    _, before = stored(spark, tmp_path, "old", base, 3)
    _, same = stored(spark, tmp_path, "same", list(reversed(base)), 3)
    assert merkle.changed_ranges(spark, before, same) == []
    assert [df.count() for df in merkle.changed_rows(spark, before, same)] == [0, 0]
    sizes = []
    for n in (1, 10, 100):
        _, after = stored(spark, tmp_path, f"new{n}", [(i, a, "c" if int(i) < n else b) for i, a, b in base], 3)
        assert len(merkle.changed_ranges(spark, before, after)) <= n
        old, new = merkle.changed_rows(spark, before, after)
        found = merkle.stored_delta(spark, before, after, COLUMNS)
        assert {(r.id, r.change, tuple(r.changed_columns)) for r in found.collect()} == {(str(i), "changed", ("b",)) for i in range(n)}
        sizes.append(old.count())
        assert sizes[-1] == new.count()
    # About five ids share one of 4,096 ranges.
    assert sizes[0] < 20 and sizes[1] < 150 and sizes[2] < 1500


def test_empty_runs(spark, tmp_path):
    _, none = stored(spark, tmp_path, "none", [], 2)
    _, also = stored(spark, tmp_path, "also", [], 2)
    _, some = stored(spark, tmp_path, "some", [("1", "x", None)], 2)
    assert merkle.stored_delta(spark, none, also, COLUMNS).collect() == []
    assert [(r.id, r.change) for r in merkle.stored_delta(spark, none, some, COLUMNS).collect()] == [("1", "new")]
    assert [(r.id, r.change) for r in merkle.stored_delta(spark, some, none, COLUMNS).collect()] == [("1", "removed")]
    _, other = stored(spark, tmp_path, "other", [("1", "x", None)], 1)
    with pytest.raises(ValueError):
        merkle.changed_ranges(spark, some, other)
