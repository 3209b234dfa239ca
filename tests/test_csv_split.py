"""CSV files read in splits against the reader that takes a file in one task."""

import random

import pytest
from pyspark.sql import functions as F

from recordlake.sources import raw, sinks
from recordlake.sources.csv_split import csv_records, read_csv_split

COLUMNS = ["id", "a", "b"]


@pytest.fixture()
def small_blocks(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    yield lambda n: [spark.conf.set(k, str(v)) for k, v in zip(before, (n, 0))]
    for k, v in before.items():
        spark.conf.set(k, v)


def texts(seed, n):
    rng = random.Random(seed)
    parts = ["x", "\n", '"', ",", "\n\n", "é", "\r\n", " ", "line\nbreak", '""', "word " * 20]
    return [(str(i), *("".join(rng.choice(parts) for _ in range(rng.choice([0, 1, 3, 9]))) for _ in range(2))) for i in range(n)]


@pytest.mark.parametrize("block", [700, 1 << 20])
def test_rows_equal_those_of_the_whole_file(spark, tmp_path, small_blocks, block):
    rows = texts(block, 400) + [("long", "y\n" * 900, '"' * 7)]
    sinks.write_csv(spark.createDataFrame(rows, COLUMNS).coalesce(1), str(tmp_path / "csv"))
    whole = sorted(tuple(r) for r in raw.read_csv(spark, str(tmp_path / "csv"), COLUMNS).collect())
    small_blocks(block)
    found = read_csv_split(spark, str(tmp_path / "csv"), COLUMNS)
    records = csv_records(spark, str(tmp_path / "csv"))
    assert sorted(tuple(r) for r in found.collect()) == whole == sorted(rows)
    blocks = {r.block_start for r in records.select("block_start").distinct().collect()}
    assert (len(blocks) > 10) == (block < 1 << 20)
    ordered = records.orderBy("file_path", "block_start", "no").collect()
    ids = [r.text.split(",", 1)[0].strip('"') for r in ordered]
    assert ids == ["id", *[r[0] for r in rows]]


def test_several_files_and_empty_ones(spark, tmp_path, small_blocks):
    rows = texts(5, 120)
    sinks.write_csv(spark.createDataFrame(rows, COLUMNS).repartition(3), str(tmp_path / "csv"))
    (tmp_path / "csv" / "part-empty.csv").write_text("")
    (tmp_path / "csv" / "part-header.csv").write_text('"id","a","b"\n')
    small_blocks(900)
    found = read_csv_split(spark, str(tmp_path / "csv"), COLUMNS)
    assert sorted(tuple(r) for r in found.collect()) == sorted(rows)


def test_no_task_writes_the_whole_table(spark, tmp_path, monkeypatch):
    """The files grow in number, not in the share of the table that one task takes."""
    from recordlake.plans import edge_queries
    from recordlake.sources import sinks

    rows = spark.range(40).selectExpr("id AS doc_id", "concat('e,', id, '\n\"') AS text")
    rows.repartition(10).write.parquet(str(tmp_path / "documents.parquet"))
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "128m")  # a task per file
    parts, write = [], sinks.write_csv
    monkeypatch.setattr(sinks, "write_csv", lambda df, path: parts.append(df.rdd.getNumPartitions()) or write(df, path))
    try:
        got = edge_queries.csv_in_splits(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)
    assert parts[0] == 3 and sorted(int(r.doc_id) for r in got) == list(range(40))
