import itertools
import random

import pytest
from pyspark.sql import functions as F

from recordlake.functions import text as tx
from recordlake.functions import typed

SAMPLES = [
    "foo\x00bar", "col1\tcol2", "line1\nline2", "abc\x7fdef", "Hello World", "  trimmed  ", "",
    "　wide　", "\u0085next\u0085", "​kept​", "é ", "  é \x01 ",
] + ["".join(p) for p in itertools.product([" ", "\x00", " ", "　", "\x1c", "x", "é", "\x80"], repeat=3)]


def test_clean_agrees_with_python_on_every_sample(spark):
    df = spark.createDataFrame(list(enumerate(SAMPLES)), "i int, s string")
    got = dict(df.select("i", tx.clean(F.col("s"))).collect())
    control = dict.fromkeys([*range(32), 127], " ")
    assert got == {i: s.translate(control).strip() for i, s in enumerate(SAMPLES)}


def test_strip_and_fill_agree_with_python(spark):
    df = spark.createDataFrame([*enumerate(SAMPLES), (-1, None)], "i int, s string")
    rows = df.select("i", "s", tx.strip_ws(F.col("s")).alias("t"), tx.is_filled(F.col("s")).alias("f"))
    for r in rows.collect():
        assert r.t == (None if r.s is None else r.s.strip())
        assert r.f == bool((r.s or "").strip())


def test_null_is_blank(spark):
    assert spark.range(1).select(tx.clean(F.lit(None).cast("string"))).first()[0] == ""


def test_number_text_is_rendered_like_python(spark):
    rng = random.Random(7)
    floats = [0.0001, 0.00012, 1e-5, 1.5e-7, 1e7, 123456789.5, 1e15, 1e16, 9999999.0, 0.5,
              -0.00098765, 1.234567890123e-4]
    floats += [rng.uniform(-180, 180) * 10 ** rng.randint(-9, 13) for _ in range(500)]
    texts = [form % f for f in floats for form in ("%r", "%.20e")]
    df = spark.createDataFrame([(t, repr(float(t))) for t in texts], "s string, want string")
    for s, want, got in df.select("s", "want", typed.text_of(typed.typed_json(F.col("s")))).collect():
        assert got == want


@pytest.mark.parametrize(
    "value,ok",
    [("48.85", True), ("-2", True), (" 7 ", True), ("1e3", True), (".5", True), ("5.", True),
     ("inf", True), ("-Infinity", True), ("", False), (None, False), ("abc", False), ("1d", False),
     ("2f", False), ("nan", False), ("NaN", False), ("1,5", False), ("0x10", False), ("--1", False)],
)
def test_is_number(spark, value, ok):
    df = spark.createDataFrame([(value,)], "v string")
    assert df.select(tx.is_number(F.col("v"))).first()[0] is ok


def test_url_parts(spark):
    url = "https://h/a/b.js?x=1&ts=99?z=2"
    row = spark.createDataFrame([(url,)], "u string").select(
        tx.url_query(F.col("u")), tx.url_base_name(F.col("u")), tx.drop_volatile(F.col("u")),
        tx.contains_any(F.col("u"), ["zz", "b.js"]), tx.contains_any(F.col("u"), ["zz"]),
    ).first()
    assert tuple(row) == (url.split("?")[1], url.split("/")[-1], url.split("&ts=")[0], True, False)


def test_snippet_is_clipped_at_both_ends(spark):
    text = "é" * 30 + "KEY" + "z" * 400
    for before, after, cap in [(80, 200, 250), (10, 200, 250), (10, 20, 15)]:
        at = text.index("KEY")
        want = text[max(0, at - before): at + after][:cap]
        df = spark.createDataFrame([(text,)], "t string")
        got = df.select(tx.snippet(F.col("t"), F.lit(at + 1), before, after, cap)).first()[0]
        assert got == want
