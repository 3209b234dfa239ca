"""SentencePiece encoding against the library that defines the ids."""

import random

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from recordlake.llm import sentencepiece_bpe as sp

ALPHABETS = ["ab ", "the and of ing", "er th in ▁ ", "\n \t", "日本語 中", "éèà ö", "a", " ", "!!??--==", "<s></s><unk><0x41> ",
             "\x00\x1c\x85 　x", "😀👍🏽 é"]


@pytest.fixture(scope="module")
def model():
    return sp.pieces(sp.model_file())


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=sp.model_file())


def texts(n, seed=1):
    rng = random.Random(seed)
    for _ in range(n):
        alphabet = rng.choice([*ALPHABETS, "".join(chr(rng.randrange(32, 0x3000)) for _ in range(20))])
        yield "".join(rng.choice(alphabet) for _ in range(rng.choice([0, 1, 2, 3, 5, 8, 20, 60, 200])))


def test_ids_and_texts_equal_the_library(model, library):
    rng = random.Random(8)
    long = ["a" * 50000, " " * 50000, " " * 50001 + "x", "ab" * 20000, "日本" * 9000, "".join(rng.choices("thering", k=20000))]
    for text in [*texts(2500), *long]:
        want = library.encode(text, add_eos=True)
        assert model.encode(text).tolist() == want, text[:80]
        assert model.decode(np.array(want)) == library.decode(want)


def test_many_texts_at_once(model, library):
    some = list(texts(800, 4))
    assert [i.tolist() for i in model.encode_texts(some)] == library.encode(some, add_eos=True)
    assert model.encode_words([]) == []


def test_any_ids_decode_as_in_the_library(model, library):
    rng = random.Random(5)
    for _ in range(400):
        ids = [rng.choice([rng.randrange(260), rng.randrange(32000)]) for _ in range(rng.randrange(12))]
        assert model.decode(np.array(ids, int)) == library.decode(ids)


def test_merges_one_by_one_give_the_same(model, library, monkeypatch):
    monkeypatch.setattr(sp, "ROUNDS", 2)
    words = ["".join(t.split()) for t in texts(300, 9)]
    want = model.encode_words(words)
    monkeypatch.undo()
    assert want == model.encode_words(words)


def test_tables(docs, no_docs, library):
    done = sp.encode_documents(docs, decoded=True).collect()
    again = {(r.doc_id, tuple(r.ids)): r.decoded for r in sp.decode_ids(sp.encode_documents(docs)).collect()}
    want = sorted((str(r.doc_id), library.encode(r.text or "", add_eos=True)) for r in docs.collect())
    assert sorted((str(r.doc_id), r.ids) for r in done) == want
    assert all(r.decoded == library.decode(r.ids) == again[r.doc_id, tuple(r.ids)] for r in done)
    assert {r.doc_id: r.ids for r in done}[1000] == [library.eos_id()]
    assert sp.encode_documents(no_docs, decoded=True).collect() == []
    nothing = docs.limit(1).select("doc_id", F.lit(None).cast("array<int>").alias("ids"))
    assert [r.decoded for r in sp.decode_ids(nothing).collect()] == [""]
