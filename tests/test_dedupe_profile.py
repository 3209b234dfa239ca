import collections
import random

import pytest
from pyspark.sql import functions as F

from recordlake.operators import dedupe, delta, profile
from recordlake.schema import OUTPUT_COLUMNS

ROWS = [
    (0, "7", "Kran", "Oslo", "Norge"),
    (1, "7", "Kran", "Oslo", "Norge"),
    (2, "8", "Hjul", "Bergen", "Norge"),
    (3, "7", "KRAN", "oslo", "NORGE"),
    (4, "7", "Kranen", "Oslo", "Norge"),
    (5, "", "", "", ""),
    (6, "", "", "", ""),
]
DDL = "seq int, id string, companyName string, city string, country string"


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_first_copy_wins_and_other_names_stay(spark):
    kept = dedupe.first_wins(spark.createDataFrame(ROWS, DDL), ["seq"])
    assert sorted(r.seq for r in kept.collect()) == [0, 2, 4, 5]


def test_a_hot_key_is_cut_before_the_shuffle(spark):
    df = spark.range(30000).select(
        F.col("id").alias("seq"),
        F.when(F.col("id") % 3 == 0, "").otherwise(F.col("id").cast("string")).alias("id"),
        F.lit("c").alias("companyName"), F.lit("x").alias("city"), F.lit("y").alias("country"),
    ).repartition(8)
    kept = dedupe.first_wins(df, ["seq"])
    assert kept.count() == 20001
    assert kept.where("id = ''").first().seq == 0
    assert "WindowGroupLimit" in plan_text(kept) and "Partial" in plan_text(kept)


def test_first_position_last_value(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice("abcdefgh"), str(rng.random())) for i in range(200)]
    df = spark.createDataFrame(rows, "pos int, text string, v string")
    last, first = {}, {}
    for pos, text, v in rows:
        first.setdefault(text, pos)
        last[text] = v
    got = dedupe.first_position_last_value(df, "text", "pos", ["v"], 5).collect()
    assert [(r.text, r.v) for r in got] == [(t, last[t]) for t in sorted(first, key=first.get)[:5]]


def test_fill_rates_flags_and_order(spark):
    df = spark.createDataFrame(
        [("1", "", " "), ("2", "x", " "), ("3", " ", "")], "b string, a string, c string"
    )
    rows = profile.fill_rates(df).collect()
    assert [(r.column_name, r.n_filled, round(r.pct, 3), len(r.bar), r.is_low) for r in rows] == [
        ("b", 3, 100.0, 20, False), ("a", 1, 33.333, 6, False), ("c", 0, 0.0, 0, True),
    ]


def test_reports_of_an_empty_table(spark):
    df = spark.createDataFrame([], ", ".join(f"{c} string" for c in OUTPUT_COLUMNS))
    assert {r.pct for r in profile.fill_rates(df).collect()} == {0.0}
    summary = profile.quality_summary(df).first()
    assert (summary.n_rows, summary.duplicate_ids, summary.bad_latitude) == (0, 0, 0)
    checks = delta.threshold_checks(df, {"id": 100}).collect()
    assert [(c.rule, c.passed) for c in checks] == [("id_fill_pct", False), ("duplicate_ids", True)]


def test_summary_counts(spark):
    df = spark.createDataFrame(
        [("1", "1.5", ""), ("1", "x", "2"), ("2", "", "nan"), ("", "-90", "181")],
        "id string, latitude string, longitude string",
    )
    assert profile.quality_summary(df).first().asDict() == {
        "n_rows": 4, "n_columns": 3, "bad_latitude": 2, "bad_longitude": 2, "duplicate_ids": 1,
    }
    assert tuple(profile.out_of_range_coordinates(df).first()) == (0, 1)


def test_value_counts_orders_ties_by_name(spark):
    rng = random.Random(1)
    values = [rng.choice(["", *"abcdefghijklmnopqrstuvwxyz"]) for _ in range(300)]
    df = spark.createDataFrame([(v,) for v in values], "country string")
    want = sorted(collections.Counter(values).items(), key=lambda kv: (-kv[1], kv[0]))[:20]
    assert [tuple(r) for r in profile.value_counts(df, "country").collect()] == want


def test_exploded_counts(spark):
    df = spark.createDataFrame([("a; b",), ("b;  ; c ",), ("",), ("a;b",)], "t string")
    assert [tuple(r) for r in profile.exploded_counts(df, "t").collect()] == [
        ("b", 2), ("a", 1), ("a;b", 1), ("c", 1),
    ]


def test_sample_rows_shows_existing_columns_in_order(spark):
    df = spark.createDataFrame([(i, f"n{i}", "x") for i in range(9, -1, -1)], "seq int, companyName string, other string")
    got = profile.sample_rows(df, ["seq"])
    assert got.columns == ["companyName"]
    assert [r.companyName for r in got.collect()] == ["n0", "n1", "n2"]


def test_delta_between_runs(spark):
    ddl = "id string, seq int, a string, b string"
    old = spark.createDataFrame(
        [("1", 0, "x", "y"), ("2", 0, "x", None), ("3", 0, "x", "y"), ("4", 0, "p", "q"), ("4", 1, "z", "z")], ddl
    )
    new = spark.createDataFrame(
        [("1", 0, "x", "y"), ("2", 0, "x", "n"), ("5", 0, "x", "y"), ("4", 3, "z", "z"), ("4", 2, "p", "q")], ddl
    )
    found = delta.snapshot_delta(old, new, ["seq"], ["a", "b"])
    assert {(r.id, r.change, tuple(r.changed_columns or ())) for r in found.collect()} == {
        ("2", "changed", ("b",)), ("3", "removed", ()), ("5", "new", ()),
    }


def test_aliases_by_map_and_by_table_agree(spark):
    df = spark.createDataFrame([(" Holland ",), ("Burma",), ("Norge",), (None,), ("",)], "country string")
    aliases = {"Holland": "Netherlands", "Burma": "Myanmar"}
    table = spark.createDataFrame(list(aliases.items()), "alias string, name string")
    want = ["", "", "Myanmar", "Netherlands", "Norge"]
    assert sorted(r[0] for r in delta.apply_aliases(df, "country", aliases).collect()) == want
    assert sorted(r[0] for r in delta.join_aliases(df, "country", table).collect()) == want


def test_null_island(spark):
    df = spark.createDataFrame([("0", "0.0"), ("0", "5"), ("", ""), ("n/a", "0")], "latitude string, longitude string")
    assert [tuple(r) for r in delta.null_island_to_null(df).collect()] == [
        (None, None), ("0", "5"), ("", ""), ("n/a", "0"),
    ]


def test_failed_rules_raise(spark):
    df = spark.createDataFrame([("1", "A"), ("1", "")], "id string, companyName string")
    checks = delta.threshold_checks(df, {"id": 100, "companyName": 99})
    assert {r.rule: r.passed for r in checks.collect()} == {
        "id_fill_pct": True, "companyName_fill_pct": False, "duplicate_ids": False,
    }
    with pytest.raises(ValueError, match="companyName_fill_pct"):
        delta.require(checks)
    delta.require(checks.where("passed"))


def test_personal_columns_are_dropped(spark):
    df = spark.createDataFrame([("",) * 39], ", ".join(f"{c} string" for c in OUTPUT_COLUMNS))
    assert len(delta.drop_pii(df).columns) == 35
