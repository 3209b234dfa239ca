"""Text rules: whitespace, control characters, URL parts, snippets, number text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: every character that counts as white space --------------------
WHITESPACE = "".join(
    map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680,
              *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)
CONTROL_CHARS = "".join(map(chr, [*range(0x20), 0x7F]))

# A number literal with an optional exponent, or an infinity; "nan" is not a number here.
NUMBER = r"(?i)^\s*[+-]?(?:inf|infinity|(?:\d+\.?\d*|\.\d+)(?:e[+-]?\d+)?)\s*$"

def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it any number of times in ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def blank_if_null(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def strip_ws(c: Column) -> Column:
    """Remove white space at both ends, including the non-ASCII kinds."""
    return F.btrim(c, F.lit(WHITESPACE))


def spaced(c: Column) -> Column:
    """Null becomes blank, each control character becomes one space."""
    text = blank_if_null(c)
    swapped = F.translate(text, CONTROL_CHARS, " " * len(CONTROL_CHARS))
    return F.when(text.rlike(r"[\x00-\x1f\x7f]"), swapped).otherwise(text)


def stripped(c: Column) -> Column:
    """White space removed at both ends of a text without control characters.

    Pure ASCII text then only needs the plain trim, which works on bytes; the slower trim
    over a character set is left for other text.
    """
    return F.when(F.octet_length(c) == F.length(c), F.trim(c)).otherwise(strip_ws(c))


def clean(c: Column) -> Column:
    """Null becomes blank, each control character becomes one space, ends are stripped."""
    return stripped(spaced(c))


def is_filled(c: Column) -> Column:
    """True when anything but white space is in the text; mostly the first byte tells."""
    visible = F.ascii(c).between(0x21, 0x7E)
    return F.coalesce(visible | (strip_ws(c) != ""), F.lit(False))


def is_number(c: Column) -> Column:
    return blank_if_null(c).rlike(NUMBER)


def contains_any(c: Column, words: Sequence[str]) -> Column:
    """True when ``c`` contains at least one of the given words, letter case as given."""
    hit = F.lit(False)
    for word in words:
        hit = hit | F.contains(c, F.lit(word))
    return hit


def url_query(url: Column) -> Column:
    """Text between the first and the second question mark; blank without one."""
    return F.split_part(url, F.lit("?"), F.lit(2))


def url_base_name(url: Column) -> Column:
    """Text after the last slash."""
    return F.substring_index(url, "/", -1)


def drop_volatile(url: Column, mark: str = "&ts=") -> Column:
    """Text before the first occurrence of a changing parameter."""
    return F.substring_index(url, mark, 1)


def snippet(text: Column, at: Column, before: int, after: int, cap: int) -> Column:
    """Characters from ``before`` ahead of 1-based ``at`` up to ``after`` behind it."""
    start = F.greatest(F.lit(1), at - before)
    return F.substring(text, start, F.least(at + after - start, F.lit(cap)))
