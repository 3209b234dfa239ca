"""A training corpus from ``documents``: five stages, each written before the next reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from recordlake.llm import bpe, forest, mixing, quality, suffixes
from recordlake.llm.queries import bpe_digests
from recordlake.llm.store import small_batches, stored, table


def accept_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 80 % of its five-word shingles."""
    small_batches(spark)
    return forest.keep_first(docs, size=5, percent=80)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 100 bytes that also start earlier."""
    small_batches(spark)
    return suffixes.without_repeats(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of each source up to its target, as one row per document and pass."""
    small_batches(spark)
    return mixing.Mix(docs).documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left, decoded again, as digests per row."""
    small_batches(spark)
    return bpe_digests(bpe.encode_documents(docs, decoded=True))


STAGES = [
    ("quality", accept_quality),
    ("near_copies", drop_near_copies),
    ("repeats", drop_repeats),
    ("mix", mix_sources),
    ("bpe", encode),
]
# Learned and sampled stages have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
