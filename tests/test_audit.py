import json
import random

from pyspark.sql import functions as F

from recordlake.operators import audit
from recordlake.sources import raw

ATTEMPT_DDL = "batch_idx int, attempt int, status int, body string, error string"


def test_positions_follow_the_total_order(spark):
    rng = random.Random(5)
    keys = [rng.choice([7, 7, 7, rng.randrange(1000)]) for _ in range(5000)]
    df = spark.createDataFrame([(k,) for k in keys], "id int").repartition(7)
    placed = audit.with_positions(df, ["id"]).collect()
    assert sorted(r.pos for r in placed) == list(range(5000))
    assert [r.id for r in sorted(placed, key=lambda r: r.pos)] == sorted(keys)


def test_a_hot_key_spreads_over_ranges(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(0, 40000, 1, 8).select(F.lit(1).alias("id"))
        placed = audit.with_positions(df, ["id"])
        parts = placed.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert placed.agg(F.min("pos"), F.max("pos"), F.count_distinct("pos")).first() == (0, 39999, 40000)
    assert len(parts) == 4 and max(r["count"] for r in parts) < 20000


def test_batches_and_groups(spark):
    ids = spark.range(123).select((F.col("id") * 3).alias("id"))
    lists = audit.batch_lists(audit.plan_batches(ids, ["id"], 10, 4), "id").orderBy("batch_idx").collect()
    want = [list(range(i, min(i + 30, 369), 3)) for i in range(0, 369, 30)]
    assert [r.ids for r in lists] == want
    assert [r.group_idx for r in lists] == [i // 4 for i in range(13)]


def test_empty_plan(spark):
    assert audit.plan_batches(spark.range(0), ["id"]).count() == 0


def test_outcomes_retries_and_lost_ids(spark):
    ok, fail = json.dumps([{"id": 1}]), '{"code": "E17"}'
    rows = [
        (0, 0, 500, fail, None), (0, 1, 500, fail, None), (0, 2, 200, ok, None),
        *[(1, a, 500, "", None) for a in range(4)],
        (2, 0, 200, "[]", None),
        (3, 0, None, None, "reset"), (3, 1, 200, "<html>", None), (3, 2, 404, fail, None),
        (4, 0, 429, ok, None), (4, 1, 500, fail, None),
        (5, 0, 200, "[5]", None),
        (6, 0, 200, '{"id":1} <extra>', None), (6, 1, 200, None, None), (6, 2, 500, ok, "late"),
        (6, 3, 200, "[1", None), (6, 4, 200, ok, None),
    ]
    outcomes = audit.attempt_outcomes(spark.createDataFrame(rows, ATTEMPT_DDL))
    named = {(r.batch_idx, r.attempt): r.outcome for r in outcomes.collect()}
    assert [named[3, a] for a in range(3)] == ["network_error", "parse_error", "empty"]
    assert [named[6, a] for a in range(4)] == ["parse_error", "parse_error", "server_error", "parse_error"]
    status = audit.batch_status(outcomes)
    got = {r.batch_idx: (r.final_status, r.attempts_made, r.n_records, r.wait_seconds) for r in status.collect()}
    assert got == {
        0: ("success", 3, 1, 6.0), 1: ("FAILED", 4, 0, 14.0), 2: ("empty", 1, 0, 0.0),
        3: ("empty", 3, 0, 6.0), 4: ("success", 1, 1, 0.0), 5: ("success", 1, 1, 0.0),
        6: ("FAILED", 4, 0, 14.0),
    }
    plan = spark.createDataFrame([(b, b * 10 + i) for b in range(7) for i in range(3)], "batch_idx int, id int")
    assert sorted(r.id for r in audit.lost_ids(plan, status).collect()) == [10, 11, 12, 60, 61, 62]


def test_backoff_schedule(spark):
    df = spark.createDataFrame([(a,) for a in range(4)], "a int")
    assert [r[0] for r in df.select(audit.backoff_seconds(F.col("a"))).collect()] == [0.0, 2.0, 4.0, 8.0]


def test_coverage_does_not_multiply_repeated_ids(spark):
    listed = spark.createDataFrame([(1,), (1,), (2,), (3,), (None,)], "id int")
    records = spark.createDataFrame([(1, "a"), (1, "b"), (9, "c"), (3, "d")], "id int, v string")
    got = {r.id: r.n_returned for r in audit.coverage(listed, records).collect()}
    assert got == {1: 2, 2: 0, 3: 1, None: 0}
    assert {r.id for r in audit.coverage_gap(listed, records).collect()} == {2, None}
    looked_up = audit.lookup_details(listed, records).collect()
    assert sorted((r.id or 0, r.v or "") for r in looked_up) == [(0, ""), (1, "a"), (1, "b"), (2, ""), (3, "d")]


def test_listing_keeps_entries_with_an_id_key(spark, lines, tmp_path):
    doc = {"partnerLocations": [
        {"id": 1, "latitude": 1.5, "longitude": 2.0, "countryId": "FR"}, {"latitude": 2.0}, {"id": None},
    ]}
    (tmp_path / "a.json").write_text(json.dumps(doc, indent=1))
    (tmp_path / "b.json").write_text("{broken")
    (tmp_path / "c.json").write_text('{"other": 1}')
    got = raw.read_locations(spark, str(tmp_path))
    assert [(r.id, r.latitude, r.countryId) for r in got.orderBy("pos").collect()] == [
        (1, 1.5, "FR"), (None, None, None),
    ]
    listings = spark.read.text(str(tmp_path), wholetext=True)
    assert raw.broken_listings(listings).count() == 1
