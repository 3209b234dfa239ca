"""Unwrapping and flattening, by example and against plain Python."""

import json

import pytest
from pyspark.sql import functions as F

from recordlake.functions import typed
from recordlake.operators import flatten, unwrap
from recordlake.schema import LIST_KEYS, OUTPUT_COLUMNS, SINGLE_KEYS
from tests import made


def flat_rows(df):
    flat = flatten.flatten_records(unwrap.explode_records(df, ["i"]), ["i", "pos"])
    return {(r.i, r.pos): {c: r[c] for c in OUTPUT_COLUMNS} for r in flat.collect()}


@pytest.fixture(scope="module")
def examples(spark, lines, full_record):
    bare = {"id": 31, "companyName": "Lone Shop"}
    dirty = {"companyName": "Two\x00Words\x01", "city": "\x7f\tBergen\n"}
    rows = flat_rows(lines([{"body": [full_record, bare, dirty]}]))
    return [rows[0, i] for i in range(3)]


EXPECTED = {
    "id": "9081", "companyName": "Fjord Elektro AS", "city": "Oslo", "country": "Norge",
    "latitude": "59.9139", "longitude": "10.7522", "contact_email": "post@fjord.example",
    "contact_phone": "+47 22 00 00 00", "firstName": "Kari", "lastName": "Nordmann",
    "about": "Switchgear since 1981", "description": "Panels and drives",
    "businessType_codes": "PB; WS", "businessType_names": "Panel builder; Wholesale; Service",
    "programLevel_globalId": "TIER2", "programLevel_displayRank": "4",
    "programLevel_logoUrl": "https://fjord.example/t2.svg", "programLevel_b2cAvailable": "false",
    "emailExists": "false", "phoneExists": "true", "eshop": "true", "productCount": "3",
    "zipCode": "0150", "address2": "", "webSite2": "", "logoUrl": "", "stateId": "",
    "openingHours": "", "competence": "", "areaOfFocus": "", "customReference": "",
}


@pytest.mark.parametrize("column", EXPECTED)
def test_full_record(examples, column):
    assert examples[0][column] == EXPECTED[column]


def test_every_column_is_present_and_text(examples):
    assert list(examples[0]) == OUTPUT_COLUMNS
    assert all(isinstance(v, str) for row in examples for v in row.values())


def test_missing_nested_parts_are_blank(examples):
    filled = {c: v for c, v in examples[1].items() if v}
    assert filled == {"id": "31", "companyName": "Lone Shop"}


def test_control_characters_become_spaces(examples):
    assert (examples[2]["companyName"], examples[2]["city"]) == ("Two Words", "Bergen")


def test_column_list():
    assert OUTPUT_COLUMNS[0] == "id"
    assert len(OUTPUT_COLUMNS) == len(set(OUTPUT_COLUMNS)) == 39


def shapes():
    """Bodies and their number of items, from the keys that may hold the list."""
    found = [([{"zip": 4}, {"zip": 5}, {"zip": 6}], 3), ([], 0), ([None, 7, "t", [], {}], 5)]
    for i, key in enumerate(LIST_KEYS):
        found.append(({key: [{"zip": i}] * (i + 1)}, i + 1))
        found.append(({key: {"zip": i}, "total": 2}, 0))
        later = LIST_KEYS[(i + 1) % len(LIST_KEYS)]
        # Of two filled lists the one whose key is named first in the rule counts.
        pair = {later: [1] * 9, key: [1] * 2}
        found.append((pair, 9 if i == len(LIST_KEYS) - 1 else 2))
        found.append(({key: [], later: [1] * 4}, 4))
    found += [({key: None}, 1) for key in SINGLE_KEYS] + [({"name": "n", "list": ["a"] * 6}, 6)]
    found += [({"total": 3, "message": "none"}, 0), (None, 0), (True, 0), (2.5, 0), ("[{}]", 0), ({}, 0)]
    return found


SHAPES = shapes()


@pytest.mark.parametrize("wrapped", [True, False])
def test_item_counts_of_every_shape(spark, lines, wrapped):
    bodies = [b for b, _ in SHAPES]
    texts = [json.dumps({"url": "u", "body": b} if wrapped else b) for b in bodies]
    counted = unwrap.records_per_line(lines(texts), ["i"])
    got = dict(counted.collect())
    assert [got[i] for i in range(len(SHAPES))] == [n for _, n in SHAPES]
    direct = lines([json.dumps(b) for b in bodies]).select("i", typed.typed_json(F.col("value")).alias("t"))
    assert dict(direct.select("i", unwrap.item_count(F.col("t"))).collect()) == got


def test_body_key_with_null_is_not_a_bare_line(lines):
    df = lines(['{"body":null,"id":1}', '{"id":1}'])
    assert sorted(flat_rows(df)) == [(1, 0)]


def test_broken_lines_give_nothing(lines):
    assert flat_rows(lines(["", "junk", "[{", '[{"id":1}],"x":2', '{"body":[{"id":1}'])) == {}


def test_false_as_word_and_as_boolean(lines):
    record = {
        "businessType": [
            {"code": "false", "name": "0"}, {"code": False, "name": 0}, {"code": 10.0, "name": "[]"},
            {"code": "  ", "name": []},
        ],
        "partnerDetails": {"descriptions": [
            {"description": "a", "isDefault": 0}, {"description": 0, "isDefault": True},
            {"description": "0", "isDefault": "false"},
        ]},
    }
    row = flat_rows(lines([{"body": [record]}]))[0, 0]
    assert row["businessType_codes"] == "false; 10.0; "
    assert row["businessType_names"] == "0; []"
    assert row["description"] == "0"


def test_malformed_nesting_blanks_only_its_field(lines):
    records = [
        {"id": 1, "city": "A", "partnerDetails": "text", "businessType": [{"code": "x"}, 7]},
        {"id": 2, "city": "B", "programLevels": {"logoUrl": "x"}, "partnerDetails": {"partnerContact": [1]}},
    ]
    rows = flat_rows(lines([{"body": records}, {"body": {"items": records}}]))
    assert {(k, r["id"], r["city"], r["businessType_codes"]) for k, r in rows.items()} == {
        ((0, 0), "1", "A", ""), ((0, 1), "2", "B", ""), ((1, 0), "1", "A", ""), ((1, 1), "2", "B", ""),
    }


def test_quarantine_names_the_fields(lines, full_record):
    records = [
        full_record,
        {"id": 1, "partnerDetails": [], "businessType": 0, "competence": "", "programLevels": {}},
        {"id": 2, "partnerDetails": "text", "businessType": [{"code": "x"}, 7]},
        {"id": 3, "partnerDetails": {"partnerContact": 5, "descriptions": [{}, "x"]}, "openingHours": 7},
        {"id": 4, "programLevels": [3]},
        5,
    ]
    got = unwrap.malformed_records(lines([{"body": {"hits": records}}, {"body": "x"}]), ["i"])
    assert {(r.pos, *r.fields) for r in got.collect()} == {
        (2, "partnerDetails", "businessType"),
        (3, "partnerDetails.partnerContact", "partnerDetails.descriptions", "openingHours"),
        (4, "programLevels"),
    }


@pytest.mark.parametrize("keys", ["true", "false"])
def test_lines_made_from_their_rows(spark, lines, keys):
    """The same rows whatever the session says about repeated keys."""
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", keys)
    drawn = made.lines(20 if keys == "true" else 21, 700)
    got = flat_rows(lines([text for text, _ in drawn]))
    spark.conf.unset("spark.sql.variant.allowDuplicateKeys")
    want = {(i, pos): row for i, (_, rows) in enumerate(drawn) for pos, row in rows.items()}
    for key, row in want.items():
        assert got.get(key) == row, drawn[key[0]][0]
    assert got.keys() == want.keys()


@pytest.mark.parametrize("text", [
    "{'id':1}", '{"body":[{"id":1}]}garbage', '[{"id":3}]x', '[{"id":1},]', '"a\tb"', "{id:1}", "01", "nan", "",
    '{"body":[{"id":1}]', "[1 2]", '{"id":1}{"id":2}',
])
def test_what_is_no_json_is_rejected_with_its_text(lines, text):
    df = lines([text, '[{"id":1}]'])
    assert [tuple(r) for r in unwrap.rejected_lines(df, ["i"]).collect()] == [(0, text)]
    assert list(flat_rows(df)) == [(1, 0)]


def test_half_a_surrogate_pair_and_deep_nesting(lines):
    deep = '{"id":1,"competence":' + "[" * 200 + "]" * 200 + "}"
    rows = flat_rows(lines(['[{"id":1,"city":"a\\ud800b"}]', f"[{deep}]", "[" * 100000]))
    assert rows[0, 0]["city"] == "a?b" and rows[1, 0]["competence"] == "[" * 199 + "]" * 199
    assert set(rows) == {(0, 0), (1, 0)}


def test_known_columns_first_then_extras(spark):
    df = spark.createDataFrame([("z", "1", "", "x")], "zeta string, id string, city string, alpha string")
    ordered = flatten.order_columns(df)
    assert ordered.columns == ["id", "city", "zeta", "alpha"]
    assert flatten.drop_empty_columns(ordered).columns == ["id", "zeta", "alpha"]


def test_short_ways_of_the_record_rules(spark):
    """Plain texts skip steps; what they give is what all steps give."""
    from recordlake.functions import text as tx

    texts = [
        None, "", " ", "a", " a", "a ", "a b", "a\n", "\n", "a\tb", "a\\", '"', 'a"b', "[", "[x", "{", "a[", "é", " é", "a\x7f", "\x01", "a\x02b",
        "\x03A", "\\u0001", "nan", "a" * 5000 + " ", 0, -0.0, 1.5, 1e22, True, False, [], {}, [1, "a", " b", 'q"', "\\", None, {"x": [True, "\x01"]}],
    ]
    rows = [(i, json.dumps([v])) for i, v in enumerate(texts)]
    one = spark.createDataFrame(rows, "i int, line string").select(
        "i", F.explode(typed.items(typed.typed_json(F.col("line")))).alias("v")
    )
    for r in one.select("i", typed.clean_text_of(F.col("v")).alias("a"), tx.clean(typed.text_of(F.col("v"))).alias("b")).collect():
        assert r.a == r.b, texts[r.i]
    written = spark.createDataFrame(rows, "i int, line string").select(
        "i", typed.joined_items(typed.typed_json(F.col("line"))).alias("t")
    )
    for r in written.collect():
        assert json.loads(r.t) == texts[r.i]


def test_many_large_lines_are_read_in_slices(monkeypatch):
    """No more than a slice of a batch is held as Python objects."""
    import pyarrow as pa


    held, write = [], typed._written
    monkeypatch.setattr(typed, "SLICE_BYTES", 1000)
    monkeypatch.setattr(typed, "_written", lambda texts, body: held.append(sum(len(t or "") for t in texts)) or write(texts, body))
    lines = [json.dumps({"body": ["x" * (k % 400)]}) for k in range(50)] + [None, "y" * 3000, '{"a":1}']
    out = typed._column(pa.array(["0", *lines]).slice(1), True)
    assert out.to_pylist() == [typed.typed_text(t, True) for t in lines]
    assert sorted(held)[-2] <= 1000 and typed._column(pa.array([], pa.string()), True).to_pylist() == []
