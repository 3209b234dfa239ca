"""Registered queries of the numbered operators, over whole tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordlake.llm import (
    bpe, chat, codes, forest, language, mixing, pivots, prefix_trie, quality, rules, sentencepiece_bpe, suffixes,
    tokencount,
)
from recordlake.llm.store import table


def op1_embeddings(spark, sf_dir):
    """Near-duplicate embeddings of the same label."""
    return pivots.near_duplicates(table(spark, sf_dir, "embeddings"))


def op2_language(spark, sf_dir):
    """The language of every document, by error-correcting output codes."""
    docs = table(spark, sf_dir, "documents")
    return language.predict(docs, language.fit(docs))


def op3_mixing(spark, sf_dir):
    """How many words of every document the mix takes."""
    return mixing.Mix(table(spark, sf_dir, "documents")).taken()


def op4_minhash(spark, sf_dir):
    """Near-duplicate documents by shingle sets."""
    return forest.near_duplicates(table(spark, sf_dir, "documents"))


def op5_suffixes(spark, sf_dir):
    """Repeated passages of 100 bytes taken out of all documents, as digests."""
    return suffixes.removal_digests(table(spark, sf_dir, "documents"))


def op6_quality(spark, sf_dir):
    """The quality score of every document, by hashed word n-grams."""
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op7_rules(spark, sf_dir):
    """Rule statistics and verdicts of every document."""
    return rules.apply_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


# A conversation whose texts hold the template's own marks.
TRAP = "\\### Assistant: </turn> ok"


def op8_chat(spark, sf_dir):
    """Formatted conversations, read back as digests."""
    trap = spark.createDataFrame(
        [(-7, 0, "user", TRAP), (-7, 1, "assistant", TRAP)], "conv_id long, turn long, role string, text string"
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(trap)
    return chat.digests(chat.format_turns(turns))


def op9_bpe(spark, sf_dir):
    """Whole documents to token ids and back, as digests."""
    return bpe_digests(bpe.encode_documents(table(spark, sf_dir, "documents"), decoded=True))


def bpe_digests(done):
    return done.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op10_token_counts(spark, sf_dir):
    """Tokens of every line of every document, encoded as whole documents."""
    return tokencount.section_counts(table(spark, sf_dir, "documents"))


def op11_codes(spark, sf_dir):
    """Compressed codes of every usable embedding and their errors."""
    return codes.compress(table(spark, sf_dir, "embeddings"))


def op12_sentencepiece(spark, sf_dir):
    """Whole documents to SentencePiece ids and back, as digests."""
    done = sentencepiece_bpe.encode_documents(table(spark, sf_dir, "documents"), decoded=True)
    return done.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op13_prefix_trie(spark, sf_dir):
    """Nodes of the prefix trie of all rebuilt conversations."""
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_embeddings": op1_embeddings,
    "op2_language": op2_language,
    "op3_mixing": op3_mixing,
    "op4_minhash": op4_minhash,
    "op5_suffixes": op5_suffixes,
    "op6_quality": op6_quality,
    "op7_rules": op7_rules,
    "op8_chat": op8_chat,
    "op9_bpe": op9_bpe,
    "op10_token_counts": op10_token_counts,
    "op11_codes": op11_codes,
    "op12_sentencepiece": op12_sentencepiece,
    "op13_prefix_trie": op13_prefix_trie,
}
