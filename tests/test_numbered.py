"""Line numbers of files read in splits, in batch and stream."""

import random

import pytest

from recordlake.sources import numbered


@pytest.fixture()
def files(spark, tmp_path):
    rng = random.Random(1)
    want = {}
    (tmp_path / "in").mkdir()
    for k in range(4):
        lines = ["x" * rng.choice([0, 1, 30, 700]) + f"é{i}" for i in range(rng.choice([0, 1, 300]) if k else 500)]
        end = "\n" if k % 2 else ""
        (tmp_path / "in" / f"f{k}.jsonl").write_text("\n".join(lines) + (end if lines else ""))
        want |= {(f"f{k}.jsonl", i + 1): line for i, line in enumerate(lines)}
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    yield tmp_path, want
    for k, v in before.items():
        spark.conf.set(k, v)


def rows(df):
    return {(r.file_path.rsplit("/", 1)[1], r.line_no): r.value for r in df.collect()}


@pytest.mark.parametrize("split", [2500, 1 << 24])
def test_batch_and_stream_number_alike(spark, files, split):
    path, want = files
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    found = numbered.read_numbered(spark, str(path / "in"))
    assert found.count() == len(want) and rows(found) == want
    query = numbered.land_numbered(spark, str(path / "in"), str(path / "out"), str(path / "state"), max_files=2)
    assert query.awaitTermination(120)
    assert rows(spark.read.parquet(str(path / "out")).drop("batch")) == want


def test_plan_has_no_shuffle_of_lines(spark, files):
    path, _ = files
    plan = numbered.read_numbered(spark, str(path / "in"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan
