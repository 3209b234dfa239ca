"""Shape questions answered from VARIANT against the strict step."""

import random

import pytest
from pyspark.sql import functions as F

from recordlake.functions import typed
from recordlake.operators import audit, unwrap

SCALARS = ['""', '"a"', '"[x"', '"#end#"', "1", "-0", "1e999", "NaN", "true", "null", '"\\u0001"', '"a\tb"', "'x'", "01"]
KEYS = ["body", "items", "results", "list", "id", "name", "x"]
AFTER = ["", "", "", " ", "x", ",1", "]", "],[1", '],"#end#"', "}"]


def value(rng, depth=0):
    kind = rng.randrange(6 if depth < 4 else 2)
    if kind < 2:
        return rng.choice(SCALARS)
    parts = [value(rng, depth + 1) for _ in range(rng.randrange(4))]
    if kind < 4:
        return "[" + rng.choice([",", ", "]).join(parts) + rng.choice(["]", "]", "]", ",]"])
    return "{" + ",".join(f'"{rng.choice(KEYS)}":{p}' for p in parts) + "}"


@pytest.mark.parametrize("lenient", ["false", "true"])
def test_counts_and_rejects_equal_the_strict_step(spark, lenient):
    rng = random.Random(7)
    texts = [value(rng) + rng.choice(AFTER) for _ in range(4000)] + ["", " ", None]
    raw = spark.createDataFrame(list(enumerate(texts)), "i int, value string").repartition(4)
    body = typed.typed_body(F.col("value"))
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", lenient)
    try:
        strict = raw.select("i", body.alias("b")).select("i", "b", unwrap.item_count(F.col("b")).alias("n")).collect()
        counted = {r.i: r.n_records for r in unwrap.records_per_line(raw, ["i"]).collect()}
        assert counted == {r.i: r.n for r in strict} and sum(counted.values()) > 200
        rejected = {r.i for r in unwrap.rejected_lines(raw, ["i"]).collect()}
        assert rejected == {r.i for r in strict if r.b is None}
        tries = raw.select("i", F.lit(0).alias("attempt"), F.lit(200).alias("status"), F.lit(None).cast("string").alias("error"), F.col("value").alias("body"))
        whole = raw.select("i", typed.typed_json(F.coalesce("value", F.lit(""))).alias("b"))
        want = {r.i: (r.b is None, r.n) for r in whole.select("i", "b", unwrap.item_count(F.col("b")).alias("n")).collect()}
        found = audit.attempt_outcomes(tries).select("i", "outcome", "n_records").collect()
        assert {r.i: (r.outcome == "parse_error", r.n_records) for r in found} == want
    finally:
        spark.conf.unset("spark.sql.variant.allowDuplicateKeys")


def test_page_files_lie_in_one_folder(spark, tmp_path, monkeypatch):
    """A file per page id, and no folder per page."""
    from recordlake.plans import edge_queries

    rows = [(1, "a"), (2, "b\nc"), (2, "b"), (3, None)]
    spark.createDataFrame(rows, "page_id long, html string").write.parquet(str(tmp_path / "pages.parquet"))
    monkeypatch.setattr(edge_queries, "scratch_path", lambda spark, name: str(tmp_path / name))
    got = sorted(r.text for r in edge_queries.page_files(spark, str(tmp_path)).collect())
    assert got == ["\n", "a\n", "b\nb\nc\n"]
    files = list((tmp_path / "pages").rglob("part-*"))
    assert len(files) == 3 and {f.parent for f in files} == {tmp_path / "pages"}
