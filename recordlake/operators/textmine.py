"""Pattern mining over page and script text."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordlake.functions.automaton import Automaton
from recordlake.functions.html import leaf_element_texts
from recordlake.functions.substrings import BLOCK_BITS, MAX_BLOCKS, Filter, word_bits
from recordlake.functions.text import contains_any, snippet, strip_ws
from recordlake.functions.typed import typed_json
from recordlake.session import pin

# --- fixed value: script blocks that hold JSON ---------------------------------------
JSON_SCRIPT = r"""(?s)<script[^>]*type=["']application/json["'][^>]*>(.*?)</script>"""

# --- fixed values: character references decoded in leaf text, "&amp;" last -----------
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&nbsp;": " ", "&amp;": "&"}


def find_all(text: Column, pattern: str, group: int = 0) -> Column:
    """All matches of one group, in text order."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def extract_all(
    df: DataFrame, text: str, pattern: str, group: int = 0, keep: Sequence[str] = ()
) -> DataFrame:
    """One row per match with its 0-based position among the matches of its text."""
    found = find_all(F.col(text), pattern, group)
    return df.select(*keep, F.posexplode(found).alias("pos", "match"))


def match_counts(
    df: DataFrame, text: str, pattern: str, group: int = 0, keep: Sequence[str] = (), sample: int = 10
) -> DataFrame:
    """Matches per text and the first few of them."""
    return df.select(*keep, find_all(F.col(text), pattern, group).alias("_found")).select(
        *keep, F.size("_found").alias("n_matches"), F.slice("_found", 1, sample).alias("sample")
    )


def distinct_matches(
    df: DataFrame,
    text: str,
    pattern: str,
    group: int = 0,
    max_length: int | None = None,
    keywords: Sequence[str] = (),
    n: int | None = None,
) -> DataFrame:
    """Distinct matches over all texts, sorted, with optional length and keyword filters."""
    found = extract_all(df, text, pattern, group).select("match").distinct()
    if max_length is not None:
        found = found.where(F.length("match") < max_length)
    if keywords:
        found = found.where(contains_any(F.col("match"), keywords))
    ordered = found.orderBy("match")
    return ordered if n is None else ordered.limit(n)


def distinct_matches_per_text(
    df: DataFrame, text: str, pattern: str, group: int = 0, keep: Sequence[str] = (), n: int = 20
) -> DataFrame:
    """The first distinct matches of each text in sorted order."""
    found = F.array_sort(F.array_distinct(find_all(F.col(text), pattern, group)))
    return df.select(*keep, F.slice(found, 1, n).alias("matches"))


def embedded_json(df: DataFrame, text: str, keep: Sequence[str] = ()) -> DataFrame:
    """JSON script blocks of each page: position, raw text, typed text (null if broken)."""
    blocks = extract_all(df, text, JSON_SCRIPT, 1, keep)
    return blocks.select(
        *keep, "pos", F.col("match").alias("blob"), typed_json(F.col("match")).alias("parsed")
    )


def keyword_hits(
    df: DataFrame,
    text: str,
    keywords: Sequence[str],
    keep: Sequence[str] = (),
    before: int = 80,
    after: int = 200,
    cap: int = 250,
    max_hits: int | None = 5,
) -> DataFrame:
    """First place of each keyword in a text with its surroundings.

    Keywords are tried in the given order; at most ``max_hits`` of them are reported per
    text. Everything happens inside the row.
    """
    body = F.col(text)
    hits = F.filter(
        F.array(
            *[
                F.struct(
                    F.lit(i).alias("keyword_pos"), F.lit(k).alias("keyword"),
                    F.locate(k, body).alias("at"),
                )
                for i, k in enumerate(keywords)
            ]
        ),
        lambda h: h["at"] > 0,
    )
    if max_hits is not None:
        hits = F.slice(hits, 1, max_hits)
    shown = F.transform(
        hits,
        lambda h: F.struct(
            h["keyword_pos"].alias("keyword_pos"),
            h["keyword"].alias("keyword"),
            (h["at"] - 1).alias("at"),
            snippet(body, h["at"], before, after, cap).alias("snippet"),
        ),
    )
    return df.select(*keep, F.inline(shown))


# Bytes of ids in one automaton; it takes some sixty times as much in every Python worker.
AUTOMATON_BYTES = 1 << 20


def known_id_hits(
    texts: DataFrame,
    ids: DataFrame,
    text_key: str,
    text: str,
    id_column: str,
    before: int = 50,
    after: int = 100,
    automaton_bytes: int = AUTOMATON_BYTES,
) -> DataFrame:
    """Ids found anywhere in a text, with the surroundings of the first place.

    An id may be any non-empty text of any length. Up to ``automaton_bytes`` of ids are searched
    at once by an automaton over the bytes of the texts. More ids stay distributed: a filter
    of at most 8 MB tells the places of a text that may begin one, and a join with the ids
    decides. Either way the texts are read once, and neither work per byte nor what passes the
    driver grows with the number of ids; with the filter, it grows with their distinct lengths.
    Place and snippet stay in the row of the text, so texts may repeat a key and are never
    shuffled; the only rows made are hits and, one in hundreds of places, candidates.
    """
    known = ids.select(F.col(id_column).cast("string").alias("_id")).where("_id <> ''").distinct()
    size = F.octet_length("_id").cast("long")
    known = pin(known.select("_id", size.alias("_size")))
    total = known.agg(F.sum("_size")).first()[0] or 0
    if total <= automaton_bytes:
        words = Automaton(sorted(r["_id"] for r in known.select("_id").collect()))
        return _searched(texts, words, text_key, text, before, after)
    found = _searched(texts, _word_filter(known), text_key, text, before, after)
    return found.join(known.select(F.col("_id").alias("known_id")), "known_id", "left_semi").select(*found.columns)


def _word_filter(known: DataFrame) -> Filter:
    """The filter of ids (_id, _size): at most 2,048 blocks of a bitmap and the distinct sizes."""
    wanted = 64 * known.count()
    blocks = 1
    while blocks < MAX_BLOCKS and blocks * BLOCK_BITS < wanted:
        blocks *= 2

    @F.arrow_udf("array<long>")
    def bits_of(words: pa.Array) -> pa.Array:
        return word_bits(words, blocks * BLOCK_BITS)

    bits = known.select(F.explode(bits_of("_id")).alias("_bit"))
    blocked = bits.select((F.col("_bit") / BLOCK_BITS).cast("int").alias("_block"), (F.col("_bit") % BLOCK_BITS).alias("_bit"))
    bitmap = np.zeros((blocks, BLOCK_BITS // 8), np.uint8)
    for r in blocked.groupBy("_block").agg(F.bitmap_construct_agg("_bit").alias("_bits")).collect():
        bitmap[r["_block"]] = np.frombuffer(r["_bits"], np.uint8)
    return Filter(bitmap.ravel(), [r["_size"] for r in known.select("_size").distinct().collect()])


def _searched(texts: DataFrame, words: Automaton | Filter, text_key: str, text: str, before: int, after: int) -> DataFrame:
    sent = texts.sparkSession.sparkContext.broadcast(words)

    @F.arrow_udf("array<struct<word:string,at:int>>")
    def search(bodies: pa.Array) -> pa.Array:
        return sent.value.search(bodies)

    body = F.col(text)
    rows = texts.select(text_key, text, F.explode(search(body)).alias("_hit"))
    at = F.col("_hit.at")
    return rows.select(
        text_key, F.col("_hit.word").alias("known_id"), at.alias("at"),
        snippet(body, at + 1, before, after, before + after).alias("snippet"),
    )


def leaf_texts(raw: Column) -> Column:
    """Stripped, non-blank texts, with their character references decoded."""

    def decode(t: Column) -> Column:
        for name, char in ENTITIES.items():
            t = F.replace(t, F.lit(name), F.lit(char))
        return strip_ws(t)

    return F.filter(F.transform(raw, decode), lambda t: t != "")


def numeric_leaf_texts(
    df: DataFrame, text: str, keep: Sequence[str] = (), max_length: int = 50, n: int = 20
) -> DataFrame:
    """The first short leaf texts of each page that hold a run of three or four digits.

    Leaves are elements without child elements, closed by an end tag or by what follows them.
    """
    leaves = df.select(*keep, leaf_element_texts(F.col(text)).alias("_raw"))
    wanted = F.filter(
        leaf_texts(F.col("_raw")), lambda t: t.rlike(r"[0-9]{3,4}") & (F.length(t) < max_length)
    )
    return leaves.select(*keep, F.posexplode(F.slice(wanted, 1, n)).alias("pos", "leaf_text"))
