"""BPE against the library that defines the ids; token counts against a slow loop."""

import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from recordlake.functions.lookup import Table
from recordlake.llm import bpe, queries, tables, tokencount

ALPHABETS = ["ab", "aab ", "the and of ing", "!!??##$$", "éèàößü ", "\n \t\r", "0123 ", "日本語中文字 ", "\x1c\x85 　x",
             "'s're'd a", "😀👍🏽 é"]


@pytest.fixture(scope="module")
def vocab():
    return bpe.vocabulary(bpe.rank_file())


@pytest.fixture(scope="module")
def library(vocab):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocab.ranks, special_tokens={})


def texts(n, seed=1):
    rng = random.Random(seed)
    for _ in range(n):
        alphabet = rng.choice([*ALPHABETS, "".join(chr(rng.randrange(32, 0x3000)) for _ in range(20))])
        yield "".join(rng.choice(alphabet) for _ in range(rng.choice([0, 1, 2, 3, 5, 8, 20, 60])))


def test_ids_equal_the_library(vocab, library):
    for text in [*texts(2500), "a" * 3000, " " * 500, "<|endoftext|>"]:
        ids = vocab.encode(text)
        assert ids.tolist() == library.encode_ordinary(text), text
        assert vocab.decode(ids) == text.encode()


def test_last_tokens_allow_appends_and_edits(vocab):
    rng = random.Random(5)
    for text in texts(300, 2):
        piece = text.encode()
        cut = rng.randint(0, len(piece))
        whole = vocab.last_tokens(piece)
        assert vocab.append(piece[:cut], vocab.last_tokens(piece[:cut]), piece[cut:]) == whole
        new = piece[:cut] + b"x" + piece[cut + 1 :]
        assert vocab.edit(piece, whole, new) == vocab.last_tokens(new)


def test_encode_and_decode_tables(docs, no_docs, library):
    done = bpe.decode_documents(bpe.encode_documents(docs)).collect()
    source = {(r.doc_id, r.text or "") for r in docs.collect()}
    assert len(done) == docs.count()
    for r in done:
        text = bytes(r.decoded).decode()
        assert (r.doc_id, text) in source
        if len(text) < 5000:
            assert np.frombuffer(r.ids, "<u4").tolist() == library.encode_ordinary(text)
    assert queries.bpe_digests(bpe.decode_documents(bpe.encode_documents(no_docs))).collect() == []


def slow_counts(text, vocab, rule):
    """Section by section, byte by byte."""
    raw = text.encode()
    sections = raw.split(b"\n")
    sections = [s + b"\n" for s in sections[:-1]] + ([sections[-1]] if sections[-1] or len(sections) == 1 else [])
    owner = [i for i, s in enumerate(sections) for _ in s]
    tokens, crossed, at = [0] * len(sections), [0] * len(sections), 0
    for i in vocab.encode(text):
        own = owner[at : at + len(vocab.bytes[i])]
        at += len(own)
        share = {s: own.count(s) for s in own}
        best = max(share.values())
        pick = {"first": own[0], "last": own[-1], "majority": min(s for s in share if share[s] == best)}[rule]
        tokens[pick] += 1
        for s in share if len(share) > 1 else []:
            crossed[s] += 1
    starts = np.cumsum([0, *(len(s.decode()) for s in sections)])
    return [(k, int(starts[k]), len(s.decode()), tokens[k], crossed[k], sum(tokens)) for k, s in enumerate(sections)]


@pytest.mark.parametrize("rule", tokencount.RULES)
def test_section_counts(spark, vocab, rule):
    rng = random.Random(8)
    rows = [(i, "".join(rng.choice(["\n", "\n\n", " \n", "word ", "é", "\n   \n", "日"]) for _ in range(rng.randrange(12)))) for i in range(80)]
    rows += [(200, None), (201, "\n"), (202, "a\n"), (203, "\n\n\n\n\n")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_tokens", F.lit(1))
    got = {}
    for r in tokencount.section_counts(df, rule).collect():
        got.setdefault(r.doc_id, []).append(tuple(r)[1:])
    assert {i: sorted(x) for i, x in got.items()} == {i: slow_counts(t or "", vocab, rule) for i, t in rows}


def test_counts_of_odd_and_empty_tables(docs, no_docs):
    rows = tokencount.section_counts(docs).collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in docs.select("doc_id").collect()}
    assert tokencount.section_counts(no_docs).collect() == []
    with pytest.raises(ValueError):
        tokencount.section_counts(docs, "some")


def test_pieces_done_together_and_alone_agree(vocab):
    rng = random.Random(11)
    pieces = [t.encode() for t in texts(600, 6)] + [b"", b"ab" * 400, bytes(range(256)), b"\xff\xfe"]
    rng.shuffle(pieces)
    want = [np.array(vocab.encode_piece(p), "<u4").tobytes() for p in pieces]
    assert vocab.encode_pieces(pieces) == want and vocab.encode_pieces([]) == []


def test_recent_results_are_bounded_and_right():
    recent, computed = tables.Recent(50), []

    def compute(new):
        computed.extend(new)
        return [2 * k for k in new]

    rng = random.Random(4)
    for _ in range(200):
        wanted = {rng.randrange(1, 400) for _ in range(20)}
        recent.learn(wanted, compute, lambda k: k < 300)
        assert all(recent[k] == 2 * k for k in wanted)
        assert len(recent) + len(recent.old) < 2 * (50 + 40)
    recent.learn({1}, compute, lambda k: True)
    before = len(computed)
    recent.learn({1}, compute, lambda k: True)
    assert len(computed) == before


def test_table_finds_every_key():
    keys = np.unique(np.random.default_rng(2).integers(0, 2**62, 5000))
    found = Table(keys, np.arange(len(keys)))
    assert (found.get(keys, -1) == np.arange(len(keys))).all()
    assert (found.get(keys[:-1] + 1, -1) == np.where(np.isin(keys[:-1] + 1, keys), np.arange(1, len(keys)), -1)).all()
    assert Table(keys[:0], keys[:0]).get(keys, 7).tolist() == [7] * len(keys)
