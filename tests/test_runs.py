"""Whole runs: files in, files out, in batch and as a stream."""

import csv
import glob
import json

import pytest
from pyspark.sql import functions as F

from recordlake.plans import run
from recordlake.schema import FINGERPRINT_COLUMNS, OUTPUT_COLUMNS
from recordlake.sources import raw as raw_source
from recordlake.sources import sinks
from recordlake.streaming import ingest
from tests import made


@pytest.fixture(scope="module")
def drawn():
    """Lines with the rows they must give, then copies in other letter case, then junk."""
    rows = made.lines(4, 150)
    pair = '[{"id":7,"companyName":"%s","city":"Oslo","about":"%s"}]'
    blank = dict.fromkeys(OUTPUT_COLUMNS, "")
    for name in ("Kran", "KRAN", "Hjul"):
        rows.append((pair % (name, name), {0: blank | {"id": "7", "companyName": name, "city": "Oslo"}}))
    return [(text, found) for text, found in rows if "\n" not in text] + [("no json", {}), ('{"body":[]}x', {})]


@pytest.fixture(scope="module")
def raw_lines(drawn):
    return [text for text, _ in drawn]


@pytest.fixture(scope="module")
def raw_dir(raw_lines, tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    for part in range(3):
        text = "\n".join(raw_lines[part * 52: (part + 1) * 52]) + "\n"
        (folder / f"raw-{part}.jsonl").write_text(text, encoding="utf-8")
    return str(folder)


def key_of(row):
    return "||".join(row[c] for c in FINGERPRINT_COLUMNS).lower()


@pytest.fixture(scope="module")
def expected(drawn):
    first = {}
    for _, rows in drawn:
        for pos in sorted(rows):
            first.setdefault(key_of(rows[pos]), rows[pos])
    return first


def as_rows(df):
    return {key_of(r): {c: r[c] for c in df.columns} for r in df.collect()}


def test_batch_run_end_to_end(spark, raw_dir, raw_lines, drawn, expected, tmp_path):
    out = str(tmp_path / "out")
    result = run.run_batch(spark, raw_dir, out, "20240101_000000", formats=("csv", "json"))
    assert result.parsed == sum(len(rows) for _, rows in drawn)
    assert (result.unique, result.rejected) == (len(expected), 2)
    assert sorted(r.line for r in result.rejects.collect()) == ["no json", '{"body":[]}x']
    filled = [c for c in OUTPUT_COLUMNS if any(r[c] for r in expected.values())]
    assert result.table.columns == filled
    want = {k: {c: r[c] for c in filled} for k, r in expected.items()}
    assert as_rows(result.table) == want

    # The backup holds the lines as they came, the export is one CSV in arrival order.
    backup = spark.read.text(sinks.run_path(out, "raw", "20240101_000000"))
    assert sorted(r.value for r in backup.collect()) == sorted(raw_lines)
    parts = sinks.run_path(out, "export_csv", "20240101_000000")
    text = b"".join(
        open(p, "rb").read()
        for folder in ("header", "rows")
        for p in sorted(glob.glob(f"{parts}/{folder}/part-*"))
    )
    assert text.startswith(b'\xef\xbb\xbf"id","')
    rows = list(csv.reader(text.decode("utf-8-sig").splitlines(keepends=True), strict=True))
    assert rows[0] == filled
    assert [r for r in rows[1:]] == [[row[c] for c in filled] for row in want.values()]

    summary = result.reports["summary"].first()
    assert (summary.n_rows, summary.n_columns) == (len(expected), len(filled))
    assert result.reports["fill_rates"].count() == len(filled)
    assert [r.companyName for r in result.reports["sample"].collect()] == [
        r["companyName"] for r in list(want.values())[:3]
    ]


def test_a_run_without_records_writes_no_export(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.jsonl").write_text('{"url":"u","body":[]}\n{"body":{"code":"E"}}\n')
    result = run.run_batch(spark, str(tmp_path / "in"), str(tmp_path / "out"), "s")
    assert (result.parsed, result.unique, result.table, result.reports) == (0, 0, None, {})
    assert not glob.glob(str(tmp_path / "out" / "export*"))


def test_stream_gives_the_same_rows_and_resumes(spark, raw_dir, raw_lines, drawn, expected, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    half = len(raw_lines) // 2
    out, state = str(tmp_path / "out"), str(tmp_path / "state")

    def drain():
        for query in ingest.run_stream(spark, str(source), out, state, backup=True):
            query.awaitTermination()

    (source / "a.jsonl").write_text("\n".join(raw_lines[:half]), encoding="utf-8")
    drain()
    (source / "b.jsonl").write_text("\n".join(raw_lines), encoding="utf-8")
    drain()
    assert spark.read.text(f"{out}/raw").count() == half + len(raw_lines)
    result = ingest.finish_stream(spark, out, "s", drop_empty=False)
    assert as_rows(result.table) == expected
    parsed = [len(rows) for _, rows in drawn]
    assert result.parsed == sum(parsed[:half]) + sum(parsed)
    assert result.unique == len(expected) and result.reports["summary"].first().n_rows == len(expected)
    assert glob.glob(f"{out}/export_csv/run_ts=s/rows/part-*")


def test_run_with_listing_and_attempts(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.jsonl").write_text('[{"id":1},{"id":1,"partnerDetails":5},{"id":2}]\n')
    entries = ",".join(f'{{"id":{i}}}' for i in range(1, 61))
    (tmp_path / "list.json").write_text(f'{{"partnerLocations":[{entries}]}}')
    attempts = [{"batch_idx": 0, "attempt": 0, "status": 200, "body": '[{"id":1}]'}]
    attempts += [{"batch_idx": 1, "attempt": 4, "status": 200, "body": '[{"id":1}]'}]
    (tmp_path / "attempts.json").write_text("\n".join(map(json.dumps, attempts)))
    result = run.run_batch(
        spark, str(tmp_path / "in"), str(tmp_path / "out"), "s", quarantine=True,
        listing_path=str(tmp_path / "list.json"), attempts_path=str(tmp_path / "attempts.json"),
    )
    assert result.reports["missing"].count() == 58
    assert {(r.batch_idx, r.final_status) for r in result.reports["batch_status"].collect()} == {(0, "success"), (1, "FAILED")}
    lost = spark.read.json(f"{tmp_path}/out/lost_ids/run_ts=s")
    assert sorted(r.id for r in lost.collect()) == list(range(51, 61))
    bad = spark.read.parquet(f"{tmp_path}/out/quarantine/run_ts=s").collect()
    assert [(r.record, r.fields) for r in bad] == [('{"id":1,"partnerDetails":5}', ["partnerDetails"])]


def test_bounded_state_variant_keeps_one_of_each_key(spark, tmp_path):
    rows = spark.range(300).select(
        (F.col("id") % 7).alias("k"), F.timestamp_seconds(F.col("id")).alias("t"), F.col("id").alias("n")
    )
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    unique = ingest.drop_seen(stream, F.col("k").cast("string"), F.col("n"), event_time="t", delay="1 day")
    ingest.drain(unique, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    assert sorted(r.k for r in spark.read.parquet(str(tmp_path / "out")).collect()) == list(range(7))


def test_csv_quotes_and_reads_back(spark, tmp_path):
    rows = [("1", 'a"b', "", " x "), ("2", "c,d", "line\nbreak", "\\"), ("", "", "", "")]
    df = spark.createDataFrame(rows, "id string, a string, b string, c string").coalesce(1)
    sinks.write_csv(df, str(tmp_path / "csv"))
    text = open(glob.glob(str(tmp_path / "csv" / "part-*"))[0], encoding="utf-8").read()
    assert text.startswith('"id","a","b","c"\n"1","a""b",""," x "\n')
    back = raw_source.read_csv(spark, str(tmp_path / "csv"), df.columns)
    assert sorted(tuple(r) for r in back.collect()) == sorted(rows)


def test_json_by_country_and_failed_ids(spark, tmp_path):
    df = spark.createDataFrame([("1", "FR"), ("2", "FR"), ("3", "DE")], "id string, country string")
    sinks.write_by_country(df, str(tmp_path / "c"))
    text = "".join(open(p).read() for p in glob.glob(str(tmp_path / "c" / "results=FR" / "*.json")))
    assert sorted(json.loads(x)["id"] for x in text.splitlines()) == ["1", "2"]
    sinks.write_failed_ids(df, str(tmp_path / "f"))
    assert spark.read.json(str(tmp_path / "f")).count() == 3


def test_configs_combine_with_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "id int, a string")
    b = spark.createDataFrame([(2, "y")], "id int, b string")
    got = run.combine_configs({"north": a, "south": b}).orderBy("id").collect()
    assert [(r.config_id, r.id, r.a, r.b) for r in got] == [("north", 1, "x", None), ("south", 2, None, "y")]


def test_pages_and_traffic_files(spark, tmp_path):
    (tmp_path / "p").mkdir()
    (tmp_path / "p" / "app.js").write_text("line 1\nline 2")
    assert tuple(raw_source.read_pages(spark, str(tmp_path / "p")).first()) == ("app.js", "line 1\nline 2")
    (tmp_path / "t.json").write_text('{"t":1.5,"method":"GET","url":"u","status":200,"body":"{}"}\n')
    row = raw_source.read_traffic(spark, str(tmp_path / "t.json")).first()
    assert (row.t, row.method, row.status, row.content_type, row.body) == (1.5, "GET", 200, None, "{}")


def test_compressed_raw_lines_stay_in_small_files(spark, tmp_path, monkeypatch):
    """A compressed file is read by one task, so it has a bounded number of lines."""
    monkeypatch.setattr(sinks, "COMPRESSED_LINES", 4)
    lines = spark.range(10).selectExpr("concat('{\"id\":', id, '}') AS value").coalesce(1)
    sinks.write_raw(lines, str(tmp_path / "gz"), compression="gzip")
    assert len(list((tmp_path / "gz").glob("*.gz"))) == 3
    back = spark.read.text(str(tmp_path / "gz"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, lines.collect()))


def test_landed_columns_are_those_of_all_landed_rows(spark, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    rows = spark.createDataFrame([('[{"id":1,"city":"A"},{"id":1,"city":"a"}]',), ('{"id":2}',), ("{",)], "value string")
    sinks.write_raw(rows.coalesce(1), raw)
    for query in ingest.run_stream(spark, raw, out, str(tmp_path / "state")):
        query.awaitTermination()
    some = ingest.landed_records(spark, out, ["id", "city"])
    assert some.columns == ["id", "city"]
    whole = ingest.landed_records(spark, out).select("id", "city")
    assert sorted(map(tuple, some.collect())) == sorted(map(tuple, whole.collect())) == [("", ""), ("1", "A"), ("2", "")]
