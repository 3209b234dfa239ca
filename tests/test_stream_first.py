"""First arrivals of a stream whose earlier copies come late."""

import time

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from recordlake.plans import edge_queries
from recordlake.streaming import first, progress

DDL = "k string, file string, line long, v string"


@pytest.fixture()
def feed(spark, tmp_path):
    """Add a batch to the stream; run it; read what was landed."""
    def add(rows):
        spark.createDataFrame(rows, DDL).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        time.sleep(1.1)  # files are taken by their time

    def start(**options):
        stream = spark.readStream.schema(DDL).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        return first.land_first_arrivals(
            stream, F.col("k"), ["file", "line"], str(tmp_path / "out"), str(tmp_path / "state"), **options
        )

    def landed():
        return spark.read.parquet(str(tmp_path / "out")).drop("batch")

    return add, start, landed


def test_late_earlier_copies_take_the_place(spark, feed):
    add, start, landed = feed
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    add([("a", "f2", 5, "a25"), ("a", "f2", 3, "a23"), ("b", "f1", 1, "b11"), (None, "f9", 1, "n91")])
    add([("a", "f1", 9, "a19"), ("b", "f1", 2, "b12"), ("c", None, 4, "c4"), (None, "f3", 1, "n31")])
    assert start().awaitTermination(120)
    add([("a", "f1", 9, "again"), ("a", "f3", 1, "a31"), ("b", "f0", 7, "b07"), ("c", "f0", 1, "c01"), ("d", "f1", 1, "d11")])
    assert start().awaitTermination(120)  # resumes with the state it had
    steps = {}
    for r in landed().collect():
        steps.setdefault(r.k, {})[r.revision] = r.v
    assert steps == {
        "a": {0: "a23", 1: "a19"}, "b": {0: "b11", 1: "b07"}, "c": {0: "c4"}, "d": {0: "d11"}, None: {0: "n91", 1: "n31"},
    }
    last = first.last_revisions(landed().union(landed()), ["file", "line"])
    assert last.columns == ["k", "file", "line", "v"]
    assert {r.k: r.v for r in last.collect()} == {"a": "a19", "b": "b07", "c": "c4", "d": "d11", None: "n31"}
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before


def test_forgotten_keys_do_no_harm(spark, feed):
    add, start, landed = feed
    add([("a", "f2", 1, "a21"), ("b", "f1", 1, "b11")])
    with pytest.raises(ValueError):
        start(keep_ms=500)
    query = start(keep_ms=500, every="300 milliseconds")
    try:
        for n, rows in ((2, [("a", "f1", 1, "a11"), ("a", "f3", 1, "a31"), ("b", "f2", 1, "b21")]), (4, None)):
            until = time.time() + 90
            while time.time() < until and not _rows(landed) >= n:
                time.sleep(0.5)
            if rows:
                time.sleep(2)
                add(rows)
    finally:
        query.stop()
    # Both keys were forgotten: what passed again is told by its place.
    assert {r.revision for r in landed().collect()} == {0} and landed().where("v = 'b21'").count() == 1
    assert {r.k: r.v for r in first.last_revisions(landed(), ["file", "line"]).collect()} == {"a": "a11", "b": "b11"}


def _rows(landed):
    try:
        return landed().count()
    except Exception:  # nothing is landed yet, or a folder is being written
        return 0


def test_progress_counts_a_repeated_batch_once(spark, feed, tmp_path):
    add, _, _ = feed
    reports, listener = [], None
    listener = progress.UniqueProgress(step=10, report=reports.append)
    add([(str(i), "f1", i, "v") for i in range(15)])
    add([(str(i), "f2", i, "v") for i in range(10, 37)])
    add([(str(i), "f0", i, "v") for i in range(40)])
    fails = tmp_path / "fails"

    def run():
        stream = spark.readStream.schema(DDL).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        passed = progress.observed(first.first_arrivals_so_far(stream, F.col("k"), ["file", "line"]), F.col("revision") == 0)

        def land(batch, batch_id):
            batch.count()
            if batch_id == 1 and not fails.exists():
                fails.touch()
                raise RuntimeError("lost")

        with first.stateful(spark):
            return passed.writeStream.foreachBatch(land).option("checkpointLocation", str(tmp_path / "s")).outputMode(
                "update").trigger(availableNow=True).start()

    spark.streams.addListener(listener)
    try:
        with pytest.raises(Exception, match="lost"):
            run().awaitTermination(120)
        assert run().awaitTermination(120)
        assert listener.ended.wait(30)
    finally:
        spark.streams.removeListener(listener)
    assert listener.total == 40 and reports == [10, 20, 30, 40]
    assert sorted(listener.by_batch) == [0, 1, 2] and listener.by_batch[1] == 22


def test_progress_goes_on_from_earlier_runs():
    reports = []
    listener = progress.UniqueProgress(step=10, report=reports.append, before=27)
    for batch, n in ((5, 2), (6, 30), (6, 31), (6, 31), (7, 0)):
        listener.count(batch, n)
    assert listener.total == 60 and reports == [30, 40, 50, 60]


def test_keys_of_a_group_share_a_call(spark, feed, monkeypatch):
    monkeypatch.setattr(first, "GROUPS", 2)
    add, start, landed = feed
    # Every key, then a few of them with late and early copies, then new and old ones.
    batches = [
        [(f"k{i}", "f5", i, f"a{i}") for i in range(200)] + [(f"k{i}", "f4", i, f"b{i}") for i in range(0, 200, 7)],
        [(f"k{i}", "f3" if i % 2 else "f6", 0, f"c{i}") for i in range(10)],
        [(None, "f2", 0, "n")] + [(f"k{i}", "f2", i, f"d{i}") for i in range(5, 230)],
    ]
    expected, place = {}, {}
    for rows in batches:
        add(rows)
        for k in {row[0] for row in rows}:
            best = min((row for row in rows if row[0] == k), key=lambda row: row[1:3])
            if k not in place or best[1:3] < place[k]:
                place[k] = best[1:3]
                expected[k, sum(key == k for key, _ in expected)] = best[3]
    query = start()
    assert query.awaitTermination(120)
    assert {(r.k, r.revision): r.v for r in landed().collect()} == expected
    assert landed().count() == len(expected)
    # One size per group beside the keys themselves.
    state = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["numInputRows"]]
    assert state == [200 + 2, 200 + 2, 231 + 2]


class _State(dict):
    """A map state and a value state that count their calls."""

    calls, value = 0, None

    def getMapState(self, *_):
        return self

    getValueState = getMapState

    def _called(self, out=None):
        self.calls += 1
        return out

    def iterator(self):
        return iter(self._called(list(self.items())))

    def getValue(self, key):
        return self._called(super().get(key))

    def updateValue(self, key, value):
        self._called(self.__setitem__(key, value))

    def get(self):
        return self._called(self.value)

    def update(self, value):
        self.value = self._called(value)


def test_state_is_read_by_the_keys_of_the_batch():
    row = Row("k", first.KEY, "line")

    def visit(keys, line):
        before = state.calls
        out = [(r.k, r.revision) for r in earliest.handleInputRows((0,), iter([row(k, k.encode(), line) for k in keys]), None)]
        return out, state.calls - before

    state, earliest = _State(), first._Earliest(["k", "line"], ["line"], None, None)
    earliest.init(state)
    names = [f"k{i}" for i in range(1000)]
    assert visit(names, 5) == ([(k, 0) for k in names], 1000 + 2)
    assert visit(names * 3, 6) == ([], 1 + 2)  # many keys: one call reads the state
    assert visit(["k1", "k2", "new"], 4) == ([("k1", 1), ("k2", 1), ("new", 0)], 2 * 3 + 2)  # few: a call per key
    assert state.value == (1001,) and state[b"k1",] == (4, 1)


def test_events_are_dealt_over_files(spark, tmp_path, monkeypatch):
    rows = [(i, i % 5, "ab"[i % 2], None) for i in range(40)]
    events = spark.createDataFrame(rows, "event_id long, user_id long, event_type string, props string")
    events.repartition(4).write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(edge_queries, "scratch_path", lambda _, name: str(tmp_path / f"made-{name}"))
    spark.conf.set("spark.sql.files.openCostInBytes", str(1 << 30))  # a task per file
    try:
        landed = spark.read.parquet(edge_queries._land_events(spark, str(tmp_path)))
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len(list((tmp_path / "made-events").glob("*.parquet"))) == 12
    # Three batches, the last third of the events first.
    assert {(r.batch, r.event_id % 3) for r in landed.collect()} == {(0, 2), (1, 1), (2, 0)}
    assert {(r.user_id, r.event_type): r.event_id for r in first.last_revisions(landed, ["event_id"]).collect()} == {
        (i % 5, "ab"[i % 2]): i for i in range(10)
    }
