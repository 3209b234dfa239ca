"""Chat formatting, mixing and the pipeline."""

import collections
import hashlib
import random
import re
import tracemalloc
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from recordlake.llm import chat, forest, mixing, oracle, queries
from tests.llm.conftest import prose
from tests.llm.test_groups import shingle_set, slow_components

SMALL = "/root/testdata/sf0.001"
TURNS = "conv_id long, turn long, role string, text string"


def turns(seed):
    rng = random.Random(seed)
    bits = ["###", "#", "####", "\\", "</turn>", "</tur", "<", "n>", ": ", "é", "日", "\n", "### Assistant: ", "ok", "</turn>\n", ""]
    rows = [(c, t, rng.choice(["user", "assistant", "system", "a:b\\###"]), "".join(rng.choices(bits, k=rng.randrange(8))))
            for c in range(40) for t in range(rng.randint(1, 6))]
    rows += [(50, 0, "assistant", None), (50, None, None, "x"), (50, 0, "assistant", "tie"), (50, 0, "assistant", "tie"),
             (None, 0, "user", "no id"), (51, 0, "assistant", "long " * 50000), (-7, 0, "user", queries.TRAP), (-7, 1, "assistant", queries.TRAP)]
    rows += [(60, t, ["user", "assistant"][t % 2], f"{t} \\") for t in range(5000)]
    return rows


def slow_digests(rows):
    by = collections.defaultdict(list)
    for c, t, role, text in rows:
        by[c].append(((t is not None, t or 0), role or "", text or ""))
    for c, own in by.items():
        own.sort()
        said = "".join(f"{r}\n{x}\n" for _, r, x in own)
        loss = "".join(x for _, r, x in own if r == "assistant")
        esc = lambda s, more="": re.sub(r"###|</turn>|[\\" + more + "]", lambda m: "\\" + m[0], s)
        size = sum(len(f"### {esc(r, ':')}: {esc(x)}</turn>\n") for _, r, x in own)
        yield (c, len(own), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), size)


def test_chat_reads_back(spark):
    rows = turns(1)
    df = spark.createDataFrame(rows, TURNS).repartition(5).withColumn("chunk", F.lit("x"))
    formatted = chat.format_turns(df)
    got = [tuple(r) for r in chat.digests(formatted).collect()]
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(got, key=key) == sorted(slow_digests(rows), key=key)
    assert formatted.where("conv_id = 60").count() > 1  # a long conversation comes in chunks
    assert chat.digests(chat.format_turns(spark.createDataFrame([], TURNS))).collect() == []


def test_broken_formats_are_noticed():
    for bad in (b"### user: x", b"x### user: y</turn>\n", b"### user: a</turn>\nrest"):
        with pytest.raises(ValueError):
            chat.parse(bad)


def test_chat_query_agrees_with_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SMALL}/conversations.parquet'")
    cursor = con.execute(oracle.ORACLE["op8_chat"])
    names = [c[0] for c in cursor.description]
    got = queries.op8_chat(spark, SMALL).select(*names).collect()
    assert sorted(map(tuple, got)) == sorted(cursor.fetchall())


def test_a_long_conversation_is_formatted_in_several_tasks(spark):
    # Small partitions would be put together.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = [(1 if i % 3 else i, i, "user" if i % 2 else "assistant", f"text {i} </turn>") for i in range(6000)]
    # Turns that only differ late in a long role or text.
    rows += [(1, 7000, "r" * (60 + i % 9), "t" * (60 + i % 7) + str(i)) for i in range(300)]
    df = spark.createDataFrame(rows, TURNS).repartition(5)
    formatted = chat.format_turns(df)
    tasks = formatted.where("conv_id = 1").select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks > 1
    got = {r.conv_id: (r.n_turns, r.turns_sha256) for r in chat.digests(formatted).collect()}
    own = sorted(r[1:] for r in rows if r[0] == 1)
    assert got[1] == (len(own), hashlib.sha256("".join(f"{role}\n{text}\n" for _, role, text in own).encode()).hexdigest())
    assert len(got) == len({r[0] for r in rows})
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


# --- mixing ----------------------------------------------------------------------------------------


def test_more_sources_than_the_driver_plans_for_are_refused(spark):
    df = spark.range(mixing.MAX_SOURCES + 1).selectExpr("id AS doc_id", "'a b c' AS text", "concat('s', id) AS source")
    with pytest.raises(ValueError, match="sources"):
        mixing.Mix(df)
    assert len(mixing.Mix(df.where("doc_id > 0")).plan) == mixing.MAX_SOURCES


def mix_rows(seed=2):
    rng = random.Random(seed)
    rows = []
    for i in range(400):
        source = rng.choice(["a", "a", "a", "b", "C", None, "é"])
        rows.append((i, prose(rng, rng.choice([0, 1, 3, 40, 200])), source))
    rows += [(900, None, "b"), (901, " \n ", "empty"), (902, "tiny one", "tiny"), (903, "w " * 5000, "long"),
             (904, "same row twice", "b"), (904, "same row twice", "b"), (None, "no id here", "b"), (None, "no id here", "C")]
    return [(i, t, "en", s, len(t or "")) for i, t, s in rows]


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def test_targets_by_hand():
    assert mixing.targets([100, 100, 100], [5, 2, 1]) == [187.5, 75.0, 37.5]
    assert mixing.targets([10, 100, 100], [5, 2, 1]) == [30.0, 120.0, 60.0]
    assert mixing.targets([1, 1, 100], [5, 2, 1]) == [3.0, 3.0, 96.0]
    assert mixing.targets([0, 5], [5, 2]) == [0.0, 5.0] and mixing.targets([], []) == []


def test_permutation_is_one():
    for n in (1, 2, 3, 17, 64, 1000, 4097):
        assert sorted(mixing.permuted(np.arange(n), n, 5).tolist()) == list(range(n))
    assert mixing.permuted(np.arange(50), 50, 1).tolist() != mixing.permuted(np.arange(50), 50, 2).tolist()


def test_shard_counts_fill_every_source():
    slots = np.array([5000, 3, 0, 900])
    rows = mixing.shard_counts(slots, 256, 1)
    total, size = collections.Counter(), collections.Counter()
    for shard, source, first, n in rows:
        assert first == total[source] and n > 0
        total[source] += n
        size[shard] += n
    assert [total[i] for i in range(4)] == slots.tolist()
    assert set(size.values()) <= {256, sum(slots) % 256}


def test_slots_are_not_broadcast_by_a_guess_of_their_size(spark):
    # 20,000 words in blocks of two: over a megabyte of slots from a few hundred bytes of draws.
    df = spark.range(40).selectExpr("id AS doc_id", "repeat('w ', 500) AS text", "concat('s', id % 3) AS source")
    mix = mixing.Mix(df, block_words=2)
    slots = sum(p[5] for p in mix.plan)
    taken = mix.taken()
    assert sum(r.taken for r in taken.collect()) == 2 * slots
    pieces = mix.pieces(mixing.stored(mix.placed(), "mix-placed"))
    assert len(pieces.collect()) == slots
    plan = pieces._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "SortMergeJoin [source_no" in plan and "Broadcast" not in plan


def test_mixed_documents_do_not_pass_the_driver(spark):
    # Small enough that a whole side of every join could be broadcast.
    df = spark.range(40).selectExpr("id AS doc_id", "repeat('w ', 500) AS text", "nullif(concat('s', id % 3), 's2') AS source")
    mix = mixing.Mix(df, block_words=2)
    made = mix.documents(df)
    assert sum(len(r.text.split()) for r in made.collect()) == 2 * sum(p[5] for p in mix.plan)
    plan = made._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "SortMergeJoin [source_no" in plan
    placed = mix.placed()
    assert placed.count() == 40
    plan = placed._jdf.queryExecution().executedPlan().toString()
    sized = [line for line in plan.splitlines() if "HashJoin [coalesce(source" in line or "MergeJoin [coalesce(source" in line]
    assert sized and all("BroadcastHashJoin" in line and "BuildRight" in line for line in sized)


def test_draws_do_not_pass_the_driver(spark):
    mix = mixing.Mix(spark.createDataFrame([(1, "a b", "s")], "doc_id long, text string, source string"))
    mix.plan = [(i, f"s{i}", 640_000, 1e6, 10_000, 15_625) for i in range(200)]  # 763 shards
    tracemalloc.start()
    drawn = mix.drawn()
    slots = mix.slots()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 2_000_000 and slots.columns == ["shard", "slot", "source_no", "block_no", "pass"]
    expected, size, at = [], collections.Counter(), collections.Counter()
    counts = list(mixing.shard_counts(np.full(200, 15_625), mixing.SLOTS_PER_SHARD, mix.seed))
    for shard, _, _, n in counts:
        size[shard] += n
    for shard, source, first, n in counts:
        expected.append((shard, source, first, n, at[shard], 10_000, size[shard]))
        at[shard] += n
    assert sorted(map(tuple, drawn.collect())) == expected


def test_mix(spark):
    rows = mix_rows()
    df = spark.createDataFrame(rows, DOCS).withColumn("size", F.lit("x")).repartition(4)
    mix = mixing.Mix(df, block_words=8)
    taken = mix.taken().collect()
    assert len(taken) == len(rows)
    again = mixing.Mix(df.repartition(2), block_words=8).taken().collect()
    assert sorted(map(str, taken)) == sorted(map(str, again))
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t or "")
    size = collections.Counter()
    for i, t, _, s, _ in rows:
        size[s] += len(words(t))
    names = sorted(size, key=lambda s: (s is None, s or ""))
    goal = dict(zip(names, mixing.targets([size[s] for s in names], [(5, 2, 1)[k % 3] for k in range(len(names))])))
    by_id = {i: (s, t) for i, t, _, s, _ in rows if i is not None}
    sums = collections.Counter()
    for r in taken:
        assert 0 <= r.taken <= 3 * r.size
        if r.doc_id is not None:
            source, text = by_id[r.doc_id]
            assert (r.size, r.source_size) == (len(words(text)), size[source])
            assert r.target == pytest.approx(goal[source])
            sums[source] += r.taken
    for source in names:
        assert abs(sums[source] - goal[source]) <= 24 + (3 * 3 if source in ("b", "C") else 0)

    # The mixed documents hold exactly the words that were taken, in their order.
    made = mix.documents(df)
    assert made.schema == df.schema
    found, whole = collections.Counter(), {(i, tuple(words(t))) for i, t, *_ in rows}
    for r in made.collect():
        own = words(r.text)
        found[r.doc_id] += len(own)
        assert r.n_chars == len(r.text)
        assert any(i == r.doc_id and _in_order(own, w) for i, w in whole)
    expected = collections.Counter()
    for r in taken:
        expected[r.doc_id] += r.taken
    assert +found == +expected


def _in_order(part, whole):
    rest = iter(whole)
    return all(w in rest for w in part)


def test_mix_of_nothing(spark, docs, no_docs):
    assert mixing.Mix(no_docs).taken().collect() == []
    assert mixing.Mix(no_docs).documents(no_docs).collect() == []
    blank = docs.where("doc_id IN (1000, 1001, 1002)")
    assert {(r.size, r.taken) for r in mixing.Mix(blank).taken().collect()} == {(0, 0)}
    assert mixing.Mix(docs).taken().count() == docs.count()


# --- pipeline ------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = [("input", docs)]
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, SMALL), name)
        out.append((name, docs))
    return dict(out)


def test_stages_keep_the_columns(stages):
    for name in ("quality", "near_copies", "repeats", "mix"):
        assert stages[name].schema == stages["input"].schema
    assert stages["bpe"].columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_quality_stage_rejects_the_labelled_bad(spark, stages):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    kept = {r.doc_id for r in stages["quality"].select("doc_id").collect()}
    truth = [(r.doc_id in kept, r.quality) for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 4 != 2]
    assert np.mean([k == bool(q) for k, q in truth]) > 0.9


def test_near_copies_stage_by_brute_force(stages):
    rows = [(r.doc_id, shingle_set(r.text, 5)) for r in stages["quality"].collect()]
    links = [(a, b) for a, x in rows for b, y in rows if a < b and x and y and 100 * len(x & y) >= 80 * len(x | y)]
    low = slow_components({i for i, _ in rows}, links)
    assert {r.doc_id for r in stages["near_copies"].collect()} == {i for i in low if low[i] == i}


def test_repeats_stage_by_brute_force(stages):
    from tests.llm.test_suffixes import brute

    rows = [(r.doc_id, r.text) for r in stages["near_copies"].collect()]
    left = {r.doc_id: r.text for r in stages["repeats"].collect()}
    for i, size, removed, _, digest in brute(rows):
        if removed == 0:
            assert left[i] == dict(rows)[i]
        elif i in left and hashlib.sha256(left[i].encode()).hexdigest() != digest:
            assert len(left[i].encode()) < size - removed  # parts of characters went as well


def test_mix_and_bpe_stages(stages):
    words = lambda df: df.select(F.sum(mixing.word_count())).first()[0]
    assert abs(words(stages["mix"]) - words(stages["repeats"])) < 0.03 * words(stages["repeats"])
    texts = collections.Counter(hashlib.sha256(r.text.encode()).hexdigest() for r in stages["mix"].collect())
    assert collections.Counter(r.decoded_sha256 for r in stages["bpe"].collect()) == texts


def test_run_gives_the_rows_of_the_stages(spark, stages):
    rows = corpus_pipeline.run(spark, SMALL).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, stages["bpe"].collect()))


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_registered_queries_run(spark, name):
    got = queries.QUERIES[name](spark, SMALL)
    source = {"op1": "embeddings", "op8": "conversations", "op11": "embeddings", "op13": "conversations"}.get(name.split("_")[0], "documents")
    key = {"embeddings": "vec_id", "conversations": "conv_id", "documents": "doc_id"}[source]
    ids = {r[0] for r in spark.read.parquet(f"{SMALL}/{source}.parquet").select(key).collect()}
    found = {r[0] for r in got.select(key).collect()} - {-7}
    # A node of the trie has the smallest of its conversations.
    assert found == ids if name != "op13_prefix_trie" else found <= ids and min(found) == min(ids)
