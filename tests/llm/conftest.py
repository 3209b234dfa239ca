"""Small tables with everything that may go wrong in a column."""

import random

import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SYLLABLES = {"aa": ["tha", "ing", "ere", "on"], "bb": ["sch", "ung", "ein", "ü"], "cc": ["que", "eau", "é", "ion"]}


def prose(rng, n, lang="aa"):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 3))) for _ in range(n))


def rows_of(seed=3, n=240):
    """Clean and bad texts of three languages; the label is the last field."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(sorted(SYLLABLES))
        text = prose(rng, rng.randint(60, 120), lang)
        good = rng.random() < 0.7
        if not good:
            text = " ".join(w + rng.choice(["###", "$$$", "%%%", "&&&"]) for w in text.split())
        rows.append((i, text, lang, rng.choice(["s1", "s2", "S0", None]), len(text), int(good)))
    return rows


ODD = [
    (1000, None, "aa", "s1", None), (1001, "", "bb", None, 0), (1002, " \n\t ", None, "s2", 4),
    (1003, "x", "aa", "s1", 1), (1004, "123 456 !!", "aa", "s1", 10), (None, "no id at all here", "cc", "s2", 17),
    (1005, "twice the same row", "aa", "s1", 18), (1005, "twice the same row", "aa", "s1", 18),
    (1006, "日本語 テキスト 😀", None, "s2", 12), (1007, "word " * 60000, "aa", "s1", 300000),
]


@pytest.fixture(scope="session")
def labelled():
    return rows_of()


@pytest.fixture(scope="session")
def docs(spark, labelled):
    """Clean, bad and odd rows, with columns whose names operators use inside."""
    df = spark.createDataFrame([r[:5] for r in labelled] + ODD, DOCS).repartition(3)
    return df.withColumns({c: F.lit("own") for c in ("id", "score", "kept", "size", "_id", "value", "label")})


@pytest.fixture(scope="session")
def labels(spark, labelled):
    rows = [(r[0], r[5], 0) for r in labelled]
    rows += [(None, 1, 0), (5, None, None), (1001, 1, 0), (99999, 0, 1), rows[0]]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
