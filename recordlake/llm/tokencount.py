"""Token counts of sections: encode whole documents once, attribute tokens by their spans.

A document is encoded as a whole, never section by section, so the counts add up to what a
model sees. Byte lengths of the tokens give their spans in the text; an interval join of
sorted spans finds the sections that each token touches. A token that crosses a border goes
to exactly one section by an explicit rule:

``majority``  the section that holds most of its bytes, the earlier one of equals
``first``     the section that holds its first byte
``last``      the section that holds its last byte
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from recordlake.llm.bpe import _type, rank_file, vocabulary
from recordlake.llm.bytesets import chunks, row_sums

RULES = ("majority", "first", "last")


def owners(token_ends: np.ndarray, borders: np.ndarray, rule: str = "majority") -> tuple[np.ndarray, np.ndarray]:
    """The section of every token, and whether the token crosses a border.

    Tokens cover the bytes without gaps and end at ``token_ends``; section i runs from
    ``borders[i]`` to the next one.
    """
    token_starts = np.concatenate([[0], token_ends[:-1]])
    first = np.searchsorted(borders, token_starts, "right") - 1
    last = np.searchsorted(borders, token_ends - 1, "right") - 1
    crossing = first != last
    if rule == "first":
        return first, crossing
    if rule == "last":
        return last, crossing
    own = first.copy()
    stops = np.append(borders[1:], token_ends[-1] if len(token_ends) else 0)
    for i in np.flatnonzero(crossing):  # few: tokens of several lines' white space
        sections = np.arange(first[i], last[i] + 1)
        held = np.minimum(stops[sections], token_ends[i]) - np.maximum(borders[sections], token_starts[i])
        own[i] = sections[np.argmax(held)]
    return own, crossing


def section_counts(docs: DataFrame, rule: str = "majority", separator: str = "\n",
                   name: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    """Tokens of every section of every whole text; a section ends with ``separator``.

    Returns doc_id, section_no (from 0), start_char, n_chars, n_tokens, n_crossing (tokens
    that touch the section and another one), doc_tokens. A null or empty text is one empty
    section without tokens. Repeated rows give repeated results, other columns are left out,
    an empty table gives an empty table. No shuffle; a task holds a few texts at a time.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    mark = separator.encode("utf-8")
    if len(mark) != 1:
        raise ValueError("separator must be a single ASCII character")

    def count(batches):
        vocab = vocabulary(rank_file(name))
        lengths = vocab.lengths
        for batch in batches:
            for row, end, data, offsets in chunks(batch.column(1)):
                texts = batch.column(1).slice(row, end - row).to_pylist()
                ids = [np.frombuffer(i, "<u4") for i in vocab.encode_texts([t or "" for t in texts])]
                per_doc = np.array([len(i) for i in ids], np.int64)
                token_ends = np.cumsum(lengths[np.concatenate([*ids, np.zeros(0, "<u4")])])
                after = np.flatnonzero(data == mark[0]) + 1
                after = after[~np.isin(after, offsets)]
                # One section at each document's start, also where the document is empty.
                borders = np.concatenate([offsets[:-1], after])
                doc = np.concatenate([np.arange(end - row), np.searchsorted(offsets, after, "right") - 1])
                order = np.lexsort((borders, doc))
                borders, doc = borders[order], doc[order]
                filled = np.flatnonzero(np.diff(np.append(borders, len(data))) > 0)
                own, crossing = owners(token_ends, borders[filled], rule)
                tokens, crossed = np.zeros((2, len(borders)), np.int64)
                tokens[filled] = np.bincount(own, minlength=len(filled))
                for side in _touched(token_ends, borders[filled], crossing):
                    crossed[filled] += np.bincount(side, minlength=len(filled))
                heads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                at = heads[borders]
                first = np.searchsorted(doc, np.arange(end - row))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(row, end - row).take(pa.array(doc)),
                        pa.array(np.arange(len(doc)) - first[doc]),
                        pa.array(at - heads[offsets[doc]]),
                        pa.array(row_sums((data & 0xC0) != 0x80, np.append(borders, len(data)))),
                        pa.array(tokens), pa.array(crossed), pa.array(per_doc[doc]),
                    ],
                    ["doc_id", "section_no", "start_char", "n_chars", "n_tokens", "n_crossing", "doc_tokens"],
                )

    schema = (
        f"doc_id {_type(docs)}, section_no long, start_char long, n_chars long, n_tokens long, "
        "n_crossing long, doc_tokens long"
    )
    return docs.select("doc_id", "text").mapInArrow(count, schema)


def _touched(token_ends, borders, crossing):
    """For every crossing token, each section that it touches, one array per step."""
    starts = np.concatenate([[0], token_ends[:-1]])[crossing]
    at = np.searchsorted(borders, starts, "right") - 1
    last = np.searchsorted(borders, token_ends[crossing] - 1, "right") - 1
    while len(at):
        yield at
        at, last = at[at < last] + 1, last[at < last]
