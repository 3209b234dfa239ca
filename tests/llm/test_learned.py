"""Classifiers: held-out accuracy, odd rows, empty tables; statistics against slow versions."""

import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from recordlake.llm import bytesets as bs
from recordlake.llm import language, quality, rules
from tests.llm.conftest import SYLLABLES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def is_held_out(i):
    return i is not None and zlib.crc32(str(i).encode()) % 4 == 2


def test_language_of_held_out_rows(docs):
    rows = language.predict(docs, language.fit(docs)).collect()
    assert len(rows) == docs.count()
    lang = {r.doc_id: r.lang for r in docs.where("doc_id < 1000").collect()}
    held = [r for r in rows if r.doc_id in lang and r.held_out]
    assert len(held) > 30 and all(r.lang_pred == lang[r.doc_id] and not r.ambiguous for r in held)
    assert all(r.held_out == is_held_out(r.doc_id) and 0 <= r.score <= 1 for r in rows)
    odd = {r.doc_id: (r.lang_pred, r.score) for r in rows if (r.doc_id or 0) >= 1000}
    assert all(odd[i] == ("und", 0.0) for i in (1000, 1001, 1002, 1004))
    assert odd[1006][0] in SYLLABLES


def test_language_learns_from_text_and_lang_alone(docs):
    other = docs.withColumn("source", F.lit("z")).where(~F.col("doc_id").eqNullSafe(1003))
    shuffled = other.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, "cc").otherwise(F.col("lang")))
    model, again = language.fit(docs.where("doc_id <> 1003")), language.fit(shuffled)
    assert model.languages == again.languages and np.allclose(model.weights, again.weights)


def test_language_without_anything_to_learn(docs, no_docs):
    model = language.fit(no_docs)
    assert {r.lang_pred for r in language.predict(docs, model).collect()} == {"und"}
    assert language.predict(no_docs, language.fit(docs)).collect() == []
    one = language.fit(docs.where("lang = 'aa'"))
    assert {r.lang_pred for r in language.predict(docs.where("doc_id < 50"), one).collect()} == {"aa"}


def test_every_language_is_learned(spark):
    """520 languages, each with its own words; the last ones are rarer."""
    words = {f"l{k:03}": [f"{chr(0x4E00 + 3 * k + i)}{chr(0x4E00 + 3 * k + (i + 1) % 3)}" for i in range(3)] for k in range(520)}
    rows = [(100 * k + i, " ".join(w * 8), lang) for k, (lang, w) in enumerate(words.items()) for i in range(8 if k < 500 else 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    model = language.fit(df)
    assert model.languages == sorted(words)
    got = {r.doc_id: r.lang_pred for r in language.predict(df, model).collect()}
    rare = [r for r in rows if r[2] >= "l500"]
    assert np.mean([got[r[0]] == r[2] for r in rare]) > 0.95 and np.mean([got[r[0]] == r[2] for r in rows]) > 0.95


@pytest.mark.parametrize("n", [0, 1, 2, 4, 9, 40])
def test_codewords_are_distinct(n):
    codes = language.codewords(n)
    assert len(codes) == n and (n < 2 or len({tuple(c) for c in codes}) == n)
    if n > 1:
        assert not (np.abs(codes.sum(0)) == n).any()


def test_quality_of_held_out_rows(docs, labels, labelled):
    weights = quality.fit(docs, labels)
    rows = quality.score(docs, weights).collect()
    assert len(rows) == docs.count()
    truth = {r[0]: r[5] for r in labelled}
    held = [r for r in rows if r.doc_id in truth and r.held_out]
    assert len(held) > 30 and np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    kept = quality.keep_good(docs, weights)
    assert kept.schema == docs.schema
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in rows if r.predicted)


def test_quality_ignores_held_out_labels(docs, labels):
    changed = labels.withColumn("quality", F.when(
        F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert np.array_equal(quality.fit(docs, labels), quality.fit(docs, changed))


def test_quality_without_labels(docs, no_docs, labels, no_labels):
    assert quality.fit(docs, no_labels) is None and quality.fit(no_docs, labels) is None
    assert {r.score for r in quality.score(docs, None).collect()} == {0.5}
    assert quality.keep_good(docs, None).count() == docs.count()
    assert quality.score(no_docs, None).collect() == []


def slow_statistics(text):
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = {}
    for i in range(len(words) - 2):
        windows.setdefault(tuple(words[i : i + 3]), []).append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


def test_rule_statistics(docs):
    texts = {}
    for r in docs.collect():
        texts.setdefault(r.doc_id, r.text)
    extra = ["a\na\na", "a\n\n a\na ", "x y z x y z x", "a b a b a b", "# a\n# a", "\x0b\x0c", "é é é", "one\r\none\r\n"]
    df = docs.sparkSession.createDataFrame([*texts.items(), *((5000 + i, t) for i, t in enumerate(extra))], "doc_id long, text string")
    for r in rules.statistics(df).collect():
        text = texts[r.doc_id] if r.doc_id in texts else extra[r.doc_id - 5000]
        assert tuple(r[c] for c in rules.BASE) == slow_statistics(text), r.doc_id


def test_rules_keep_good_and_refuse_bad_rows(docs, labels, labelled):
    rows = rules.apply_rules(docs, labels).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.kept and r.base_failed)
    kept = {r.doc_id: r.kept for r in rows}
    assert np.mean([kept[r[0]] == bool(r[5]) for r in labelled if is_held_out(r[0])]) > 0.97


@pytest.mark.parametrize("kind", ["above", "below"])
def test_labels_refuse_rows_within_the_fixed_limits(spark, kind):
    """Good texts differ in one statistic from bad ones; none exceeds what the rules allow."""
    rng = np.random.default_rng(4)
    rows, marks = [], []
    for i in range(1200):
        words = ["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(100)]
        bad = i % 4 == 0
        if kind == "above":  # 8 of 100 words are symbols, the good ones have at most 1
            for k in range(8 if bad else int(rng.integers(0, 2))):
                words[7 * k] = "#"
        elif bad:  # words of three letters, the good ones have five
            words = [a[:3] for a in words]
        rows.append((i, " ".join(words)))
        marks.append((i, int(not bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    assert all(r[name] <= most for r in rules.statistics(docs).collect() for name, most in rules.ALLOWED.items())
    kept = {r.doc_id: r.kept for r in rules.apply_rules(docs, labels).collect()}
    held = [i for i, _ in rows if is_held_out(i)]
    assert np.mean([kept[i] == bool(i % 4) for i in held]) > 0.97


def test_rules_without_rows_or_labels(docs, no_docs, labels, no_labels):
    assert rules.apply_rules(no_docs, labels).collect() == []
    assert rules.apply_rules(docs, no_labels).where("kept").count() > 100
    assert rules.apply_rules(docs.where("doc_id >= 1000 AND doc_id < 1007"), labels).where("kept").count() == 0


def test_isolation_forest_finds_the_far_point():
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(0, 1, (300, 3)), [[9.0, 9.0, 9.0]]])
    scores = rules.grow(x, 60, 64).scores(x)
    assert scores.argmax() == 300 and scores[300] > 0.65


def test_word_hashes_follow_the_words():
    import pyarrow as pa

    texts = pa.array(["one two one", None, "", "two\x0bone", "é one"])
    data, offsets = bs.flat(texts)
    starts, ends, word_offsets = bs.words(data, offsets)
    found = [bytes(data[a:b]).decode() for a, b in zip(starts, ends)]
    assert found == ["one", "two", "one", "two", "one", "é", "one"] and word_offsets.tolist() == [0, 3, 3, 3, 5, 7]
    hashes = bs.span_hashes(data, starts, ends)
    assert len(set(hashes.tolist())) == 3 and hashes[0] == hashes[2] == hashes[4] == hashes[6]
    pairs, first = bs.grams(hashes, word_offsets, 2)
    assert first.tolist() == [0, 1, 3, 5] and pairs[1] == pairs[2]


def test_rules_learn_from_every_labelled_row(spark):
    rng = np.random.default_rng(3)
    n = 45_000
    shape = np.round(rng.gamma(2.0, 0.05, (n, len(rules.SHAPE))), 3)
    label = (rng.random(n) < 0.8).astype(int)
    shape[label == 0] *= 3
    rows = [(i, 100, 500, 0, 0, 0, *map(float, shape[i])) for i in range(n)]
    ddl = "doc_id long, " + ", ".join([*(f"{c} long" for c in rules.BASE), *(f"{c} double" for c in rules.SHAPE)])
    stats = spark.createDataFrame(rows, ddl)
    labels = spark.createDataFrame([(i, int(label[i])) for i in range(n)], "doc_id long, quality int")
    forest = rules.fit(stats, labels)
    known = np.array([zlib.crc32(str(i).encode()) % 4 != 2 for i in range(n)])
    good = shape[known & (label == 1)]
    low, high = np.quantile(good, [(1 - rules.KEEP_GOOD) / 2, (1 + rules.KEEP_GOOD) / 2], axis=0)
    margin = rules.MARGIN * (high - low)
    assert np.allclose(forest.low, low - margin, rtol=0, atol=1e-12)
    assert np.allclose(forest.high, high + margin, rtol=0, atol=1e-12)
    scores = forest.scores(rules.outside(shape[known], forest.low, forest.high))
    cuts, fine = np.unique(scores), label[known] == 1
    limits = np.append((cuts[1:] + cuts[:-1]) / 2, cuts[-1])
    accepted = np.array([(scores[fine] <= c).mean() for c in limits])
    refused = np.array([(scores[~fine] > c).mean() for c in limits])
    value = np.where(accepted >= rules.KEEP_GOOD, accepted + refused, -1)
    assert forest.limit == pytest.approx(limits[np.flatnonzero(value >= value.max() - 1e-12)[-1]])
