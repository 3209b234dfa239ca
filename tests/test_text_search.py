"""Page mining, traffic logs and JSON search against plain Python."""

import json
import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from recordlake.functions import automaton
from recordlake.operators import jsonpath, textmine, traffic

PAGE = """<html><head><title>Shop 1234</title><script>var n = "<b>999</b>";</script>
<script type="application/json" id="x">{"a": 1}</script>
<script id='y' type='application/json'>
{"b": [1,
2]}</script></head><body><p>Over 500 shops<br>since 1999</p><li>12</li><LI>&lt;777&gt;</LI>
<div><span>call 5551234 now</span></div><p>this leaf text has 321 in it but it is far too long to be shown</p>
<a href="/x">x</a><a href="/a">a</a><a href="/x">x</a></body></html>"""


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(1, PAGE), (2, "no markup 4711"), (3, "")], "k int, html string")


def test_matches_counts_and_sets(pages):
    pattern = 'href="(/[^"]*)"'
    got = textmine.extract_all(pages, "html", pattern, 1, ["k"]).collect()
    assert [(r.k, r.pos, r.match) for r in got] == [(1, i, m) for i, m in enumerate(re.findall(pattern, PAGE))]
    counts = {r.k: (r.n_matches, r.sample) for r in textmine.match_counts(pages, "html", r"\b\d{3,4}\b", 0, ["k"], 2).collect()}
    assert counts[1] == (len(re.findall(r"\b\d{3,4}\b", PAGE)), ["1234", "999"])
    assert counts[3] == (0, [])
    assert [r.match for r in textmine.distinct_matches(pages, "html", pattern, 1).collect()] == ["/a", "/x"]
    assert [r.match for r in textmine.distinct_matches(pages, "html", pattern, 1, keywords=["x"]).collect()] == ["/x"]
    assert textmine.distinct_matches(pages, "html", pattern, 1, max_length=2).count() == 0
    per_page = {r.k: r.matches for r in textmine.distinct_matches_per_text(pages, "html", pattern, 1, ["k"]).collect()}
    assert per_page == {1: ["/a", "/x"], 2: [], 3: []}


def test_embedded_json_spans_lines(pages):
    blocks = textmine.embedded_json(pages, "html", ["k"])
    assert [json.loads(r.blob) for r in blocks.collect()] == [{"a": 1}, {"b": [1, 2]}]
    assert blocks.where("parsed is null").count() == 0


def test_leaf_texts_with_numbers(pages):
    got = textmine.numeric_leaf_texts(pages, "html", ["k"]).collect()
    assert [r.leaf_text for r in got] == ["Shop 1234", 'var n = "<b>999</b>";', "<777>", "call 5551234 now"]
    assert len(textmine.numeric_leaf_texts(pages, "html", ["k"], n=2).collect()) == 2


def test_keyword_hits_in_list_order(pages):
    words = ["zzz", "li", "body", "html", "title", "shops", "span"]
    hits = textmine.keyword_hits(pages, "html", words, ["k"], 80, 200, 250, 5).collect()
    found = [w for w in words if w in PAGE][:5]
    assert [(r.keyword, r.at) for r in hits] == [(w, PAGE.index(w)) for w in found]
    for r in hits:
        assert r.snippet == PAGE[max(0, r.at - 80): r.at + 200][:250]


@pytest.mark.parametrize("room", [1 << 20, 60])
def test_known_ids_equal_substring_search(spark, room):
    """Ids of any letters and length, texts that share a key, one automaton and several."""
    rng = random.Random(2)
    texts = ["".join(rng.choice("0123 ab.-é") for _ in range(rng.randrange(80))) for _ in range(60)] + ["", None]
    ids = ["".join(rng.choice("0123 ab.-é") for _ in range(rng.randrange(1, 5))) for _ in range(80)]
    texts += ["x 12345678901234567890123 AB-77", "y 12345678901234567890123"]
    ids += ["12345678901234567890123", "AB-77", "-5", "", None, "12345678901"]
    t = spark.createDataFrame([(k % 7, x) for k, x in enumerate(texts)], "k int, text string")
    i = spark.createDataFrame([(x,) for x in ids], "id string")
    found = textmine.known_id_hits(t, i, "k", "text", "id", automaton_bytes=room).collect()
    got = sorted((r.k, r.known_id, r["at"], r.snippet) for r in found)
    want = []
    for k, text in enumerate(texts):
        for x in set(ids) - {"", None}:
            if x in (text or ""):
                at = text.index(x)
                want.append((k % 7, x, at, text[max(0, at - 50): at + 100]))
    assert got == sorted(want)


def test_known_ids_of_nothing(spark):
    some, none = spark.createDataFrame([(1, "a")], "k int, text string"), spark.createDataFrame([], "k int, text string")
    ids = spark.createDataFrame([("a",), ("",), (None,)], "id string")
    assert textmine.known_id_hits(none, ids, "k", "text", "id").collect() == []
    assert textmine.known_id_hits(some, ids.where("id = ''"), "k", "text", "id").collect() == []
    assert [tuple(r) for r in textmine.known_id_hits(some, ids, "k", "text", "id").collect()] == [(1, "a", 0, "a")]


@pytest.mark.parametrize("alphabet,n,size", [("ab", 60, 7), ("abc é", 400, 5), ("a", 9, 12), ("01日", 30, 300)])
def test_automaton_finds_every_word(alphabet, n, size, monkeypatch):
    """Overlapping and nested words, texts cut into lanes, empty texts, slices of buffers."""
    rng = random.Random(n)
    words = sorted({"".join(rng.choice(alphabet) for _ in range(rng.randrange(1, size))) for _ in range(n)})
    texts = [None, "", *("".join(rng.choice(alphabet) for _ in range(rng.choice([1, 5, 30, 4000]))) for _ in range(40))]
    texts.append("".join(words))
    monkeypatch.setattr(automaton, "LANE", 16)
    monkeypatch.setattr(automaton, "CHUNK_BYTES", 3000)
    machine = automaton.Automaton(words)
    got = machine.search(pa.array(["x", *texts]).slice(1)).to_pylist()
    assert len(got) == len(texts)
    for text, hits in zip(texts, got):
        places = {h["word"]: h["at"] for h in hits}
        assert len(places) == len(hits) and [h["at"] for h in hits] == sorted(h["at"] for h in hits)
        assert places == {w: text.index(w) for w in words if w in (text or "")}
    assert automaton.Automaton([]).search(pa.array(["a", None])).to_pylist() == [[], []]
    assert machine.search(pa.array([], pa.string())).to_pylist() == []


def test_automaton_steps_do_not_grow_with_the_words(monkeypatch):
    """The same text against ten times the words: as many moves of as many lanes."""
    rng, moves = random.Random(1), []
    words = list({"".join(rng.choices("0123456789", k=9)) for _ in range(20000)})
    text = pa.array(["".join(rng.choices("0123456789 ", k=20000))])
    move = automaton.Automaton.move
    monkeypatch.setattr(automaton.Automaton, "move", lambda self, node, byte: moves.append(len(node)) or move(self, node, byte))
    work = []
    for n in (2000, 20000):
        machine = automaton.Automaton(words[:n])
        moves.clear()
        machine.search(text)
        work.append(sum(moves))
    assert work[0] == work[1] < 1.02 * 20000


LOG = [
    (0, "2024-01-01 00:00:05", "GET", "https://h/api/locate?x=1", 200, "application/json", None),
    (1, "2024-01-01 00:00:02.5", "POST", "https://h/partner?countryCode=gb", 200, "text/javascript", '{"ids":[1,2,3,4,5,6,7]}'),
    (2, "2024-01-02 01:00:02.500001", "POST", "https://h/partner", 500, "application/json", '{"q":"GB"}'),
    (3, "2024-01-01 00:00:09", "GET", "https://h/img", 200, "image/png", "no json"),
    (4, "2024-01-01 00:00:09", "GET", "https://h/img", 200, "image/png", ""),
]


@pytest.fixture(scope="module")
def log(spark):
    df = spark.createDataFrame(LOG, "seq int, t string, method string, url string, status int, content_type string, body string")
    return df.withColumn("ts", F.col("t").cast("timestamp_ntz")).withColumn("s", F.col("seq") % 2)


def test_elapsed_times(log):
    assert [r.elapsed_us for r in traffic.with_elapsed(log).orderBy("seq").collect()] == [
        2_500_000, 0, 90_000_000_001, 6_500_000, 6_500_000,
    ]
    by_session = traffic.with_session_elapsed(log, "s").orderBy("seq").collect()
    assert [r.elapsed_us for r in by_session] == [0, 0, 90_000_000_001 - 2_500_000, 6_500_000, 4_000_000]


def test_traffic_filters(log):
    assert [r.seq for r in traffic.api_responses(log).collect()] == [0, 1, 2]
    assert [r.seq for r in traffic.api_responses(log, status=200, method="POST").collect()] == [1]
    assert [r.seq for r in traffic.api_responses(log, keywords=["locate", "zz"]).collect()] == [0]
    assert [r.seq for r in traffic.after_mark(log, 3).collect()] == [3, 4]
    uk = log.where(traffic.mentions_value(F.col("url"), F.col("body"), "countryCode", "gb"))
    assert [r.seq for r in uk.collect()] == [1, 2]


def test_ids_of_request_bodies(log):
    rows = traffic.request_ids(log, keep=["seq"]).collect()
    assert [(r.seq, r.n_ids, r.first_ids, r.preview) for r in rows] == [
        (1, 7, ["1", "2", "3", "4", "5"], None),
        (2, None, None, '{"q":"GB"}'),
        (3, None, None, "no json"),
    ]


def walk(value, path, depth, found):
    """Every ids list with more than ten items, at most four steps below the root."""
    entries = value.items() if isinstance(value, dict) else enumerate(value)
    for k, v in entries:
        here = f"{path}.{k}"
        if k == "ids" and isinstance(v, list) and len(v) > 10:
            found.append((here, len(v), [str(x) for x in v[:5]]))
        if isinstance(v, (dict, list)) and depth < 4:
            walk(v, here, depth + 1, found)
    return found


def random_tree(rng, depth):
    if depth == 0 or rng.random() < 0.2:
        return rng.choice([None, 1, "x", True, list(range(rng.randrange(8, 14)))])
    if rng.random() < 0.25:
        return [random_tree(rng, depth - 1) for _ in range(rng.randrange(4))]
    return {k: random_tree(rng, depth - 1) for k in rng.sample(["ids", "a", "b", "c"], 3)}


def test_named_arrays_equal_a_plain_walk(spark):
    rng = random.Random(11)
    trees = [{"r": random_tree(rng, 5), "ids": random_tree(rng, 2)} for _ in range(120)]
    df = spark.createDataFrame([(i, json.dumps(t)) for i, t in enumerate(trees)], "i int, t string")
    got = sorted((r.i, r.path, r.n_items, r["sample"]) for r in jsonpath.named_arrays(df, "t", keep=["i"]).collect())
    want = sorted((i, *hit) for i, t in enumerate(trees) for hit in walk(t, "$", 1, []))
    assert want and got == want


def test_named_arrays_scan_the_input_once(spark):
    df = spark.range(5).select(F.try_parse_json(F.lit('{"ids":[1]}')).alias("v"))
    plan = jsonpath.named_arrays(df, "v")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (") == 1 and "Join" not in plan


def test_id_lists_and_country_keys(spark):
    long = list(range(60))
    docs = [
        {"a": long, "b": long[:50], "c": [str(x) for x in long], "d": [0.5, *long], "e": [True, *long]},
        {"z": {"big": 1, "Countries": long[:11], "country": long[:12]}, "a": {"countryList": long}},
        {"z": {"country": long[:10]}, "y": [{"country": long}]},
        [1, 2],
    ]
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "i int, body string")
    got = jsonpath.id_list_keys(df, "body", keep=["i"]).collect()
    assert sorted((r.i, r.key, r.n_items) for r in got) == [(0, "a", 60), (0, "e", 61)]
    got = jsonpath.key_arrays(df, "body", keep=["i"]).collect()
    assert [(r.i, r.path, r.n_items, r["sample"]) for r in got] == [(1, "z.Countries", 11, ["0", "1", "2", "3", "4"])]


def test_response_shapes(spark):
    bodies = [
        '[{"a":1},2]', "[]", "[7]", '{"totalCount":3,"count":9,"message":"m","code":"c"}',
        '{"total":null,"count":5}', '{"x":1}', "oops", '{"x":1} tail', "5",
    ]
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "i int, body string")
    rows = jsonpath.response_shapes(df, keep=["i"]).orderBy("i").collect()
    assert [(r.shape, r.n_items, r.first_item, r.total, r.detail) for r in rows] == [
        ("list", 2, "object", None, None), ("list", 0, None, None, None), ("list", 1, "bigint", None, None),
        ("object", None, None, "3", "m"), ("object", None, None, None, '{"total":null,"count":5}'),
        ("object", None, None, None, '{"x":1}'), ("raw", None, None, None, None),
        ("raw", None, None, None, None), ("raw", None, None, None, None),
    ]
    marks = df.select(jsonpath.has_any_key(F.col("body"))).collect()
    assert [r[0] for r in marks] == [False, False, False, True, True, False, False, False, False]


def test_more_ids_than_an_automaton_takes_read_the_texts_once(spark):
    """Neither the plan nor what the driver holds grows with the number of ids."""
    rng = random.Random(8)
    words = sorted({"".join(rng.choice("ab1é") for _ in range(rng.choice([1, 2, 3, 7, 8, 9, 16, 17, 40]))) for _ in range(600)})
    texts = spark.createDataFrame(
        [(k % 5, "".join(rng.choice("ab1é") for _ in range(300)) + rng.choice(words)) for k in range(60)] + [(0, None), (1, "")],
        "k int, text string",
    )
    ids = spark.createDataFrame([(w,) for w in words], "id string")
    many = textmine.known_id_hits(texts, ids, "k", "text", "id", automaton_bytes=50)
    plan = many._jdf.queryExecution().executedPlan().toString()
    assert "Union" not in plan
    one = textmine.known_id_hits(texts, ids, "k", "text", "id")
    assert sorted(map(tuple, many.collect())) == sorted(map(tuple, one.collect()))
