"""Typed JSON text: JSON in which the type of every scalar can be read off its text.

Spark's typed reader hands over scalars as plain text: the word ``"false"`` and the boolean
look the same, numbers are rewritten, and what is accepted depends on reader settings. One
small Arrow-batched step therefore checks each text with a strict parser and writes it again
with marks; everything after it is DataFrame expressions over that text.

- a number is a string: mark 1, then its plain text (``1e-05``, ``10000000.0``, ``nan``, ``inf``);
- a boolean is a string: mark 2, then ``true`` or ``false``;
- a string that starts like a list, an object or a mark gets mark 3 in front, so any text
  that starts with a bracket is a list or an object; other strings stay as they are;
- the characters of the marks inside strings are written as mark 3 and A, B or C;
- of repeated keys the last one counts; a text that is not exactly one JSON value is null.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from recordlake.functions.text import let, spaced, stripped

NUMBER, BOOLEAN, TEXT = "\x01", "\x02", "\x03"
_STARTS = frozenset("[{" + NUMBER + BOOLEAN + TEXT)
_INNER = {1: TEXT + "A", 2: TEXT + "B", 3: TEXT + "C"}
_WORDS = {True: BOOLEAN + "true", False: BOOLEAN + "false"}
FALSY = ["", NUMBER + "0", NUMBER + "0.0", NUMBER + "-0.0", _WORDS[False], "[]", "{}"]


class _Marked(str):
    """Text of a number or boolean: already marked."""


def _whole(digits: str) -> str:
    return _Marked(NUMBER + (str(int(digits)) if len(digits) > 18 or digits == "-0" else digits))


def _fraction(digits: str) -> str:
    value = float(digits)
    return _Marked(NUMBER + repr(value))


def _mark(value):
    if value is True or value is False:
        return _WORDS[value]
    if type(value) is list:
        return [_mark(v) for v in value]
    if type(value) is str and value[:1] in _STARTS:
        return TEXT + value
    return value


# Without escapes of control characters no string begins with a mark, so a number's text is
# told from a string by its mark alone, and objects come as they were read.


def _plain_whole(digits: str) -> str:
    return NUMBER + (str(int(digits)) if len(digits) > 18 or digits == "-0" else digits)


def _plain_fraction(digits: str) -> str:
    return NUMBER + repr(float(digits))


def _plain_mark(value):
    if value is True or value is False:
        return _WORDS[value]
    if type(value) is list:
        return [_plain_mark(v) for v in value]
    if type(value) is str and (value[:1] == "[" or value[:1] == "{"):
        return TEXT + value
    return value


def _plain_fields(read: dict) -> dict:
    # As ``_plain_mark`` for each value, without a call for those that stay as they are.
    for k, v in read.items():
        kind = type(v)
        if kind is str:
            first = v[:1]
            if first == "[" or first == "{":
                read[k] = TEXT + v
        elif kind is list or kind is bool:
            read[k] = _plain_mark(v)
    return read


def _inner(value):
    if type(value) is str:
        return value.translate(_INNER)
    if type(value) is list:
        return [_inner(v) for v in value]
    return value


def _fields_with_marks(pairs):
    return {k.translate(_INNER): _mark(_inner(v)) for k, v in pairs}


_plain = json.JSONDecoder(
    object_hook=_plain_fields, parse_int=_plain_whole, parse_float=_plain_fraction, parse_constant=_plain_fraction
).decode
_careful = json.JSONDecoder(
    object_pairs_hook=_fields_with_marks, parse_int=_whole, parse_float=_fraction, parse_constant=_fraction
).decode
_write = json.JSONEncoder(ensure_ascii=False, separators=(",", ":"), check_circular=False).encode


def typed_text(text: str | None, body: bool = False) -> str | None:
    """Typed text of one JSON text; with ``body`` that of its ``body`` key, if it has one."""
    try:
        if "\\u00" in text:
            value = _careful(text)
            value = _mark(value if isinstance(value, (dict, _Marked)) else _inner(value))
        else:
            value = _plain_mark(_plain(text))
    except (ValueError, TypeError, RecursionError):
        return None
    if body and type(value) is dict and "body" in value:
        value = value["body"]
        if value is None:
            return "null"
    if type(value) is str or type(value) is _Marked:
        return value
    return _write(value)


# Texts of a batch that are Python objects at once: a few MB of them, or one longer text.
SLICE_BYTES = 1 << 22


def _slices(texts: pa.Array):
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    row = 0
    while row < len(texts):
        end = int(np.searchsorted(ends, (ends[row - 1] if row else 0) + SLICE_BYTES, "right"))
        yield texts.slice(row, max(end - row, 1))
        row = max(end, row + 1)


def _column(texts: pa.Array, body: bool) -> pa.Array:
    parts = [_written(part.to_pylist(), body) for part in _slices(texts)]
    return pa.concat_arrays(parts) if parts else pa.array([], pa.string())


def _written(texts: list[str | None], body: bool) -> pa.Array:
    out = [typed_text(t, body) for t in texts]
    try:
        return pa.array(out, pa.string())
    except UnicodeEncodeError:  # half of a surrogate pair: no character
        return pa.array([t and t.encode("utf-8", "replace").decode() for t in out], pa.string())


@F.arrow_udf(StringType())
def _typed(texts: pa.Array) -> pa.Array:
    return _column(texts, False)


@F.arrow_udf(StringType())
def _typed_body(texts: pa.Array) -> pa.Array:
    return _column(texts, True)


def typed_json(text: Column) -> Column:
    """Typed text of a JSON value; null when the text is null or not one complete value."""
    return _typed(text)


def typed_body(line: Column) -> Column:
    """Typed text of a raw line's ``body``, or of the whole line when it has no such key."""
    return _typed_body(line)


def is_json(text: Column) -> Column:
    """True for exactly one complete JSON value."""
    return _typed(text).isNotNull()


def is_list(value: Column) -> Column:
    return F.coalesce(F.startswith(value, F.lit("[")), F.lit(False))


def is_object(value: Column) -> Column:
    return F.coalesce(F.startswith(value, F.lit("{")), F.lit(False))


def is_container(value: Column) -> Column:
    return F.coalesce(F.ascii(value).isin(ord("["), ord("{")), F.lit(False))


def is_truthy(value: Column) -> Column:
    """False for null, false, zero, blank text and empty containers."""
    return value.isNotNull() & ~value.isin(*FALSY)


def kind(value: Column) -> Column:
    """object, array, bigint, double, boolean, void (null) or string."""
    first = F.ascii(value)
    return (
        F.when(value.isNull(), "void").when(first == ord("{"), "object").when(first == ord("["), "array")
        .when((first == 1) & value.rlike("^.-?[0-9]+$"), "bigint").when(first == 1, "double")
        .when(first == 2, "boolean").otherwise("string")
    )


def _unescaped(text: Column) -> Column:
    """Characters of the marks as they were inside a string."""
    out = text
    for code, written in _INNER.items():
        out = F.replace(out, F.lit(written), F.lit(chr(code)))
    return F.when(F.contains(text, F.lit(TEXT)), out).otherwise(text)


def text_of(value: Column) -> Column:
    """Plain text of a value: scalars without marks, lists and objects as compact JSON."""
    first = F.ascii(value)
    rest = F.substring(value, 2, 2**31 - 1)
    return (
        F.when(first.isin(1, 2), rest).when(first == 3, _unescaped(rest))
        .when(first.isin(ord("["), ord("{")), compact_json(value)).otherwise(_unescaped(value))
    )


# A string of printable ASCII that neither starts like a list or object nor begins or ends with
# a space: its own clean text.
_PLAIN = r"\A[!-Z\\-z|-~][ -~]*+(?<! )\z"


def clean_text_of(value: Column) -> Column:
    """As ``clean(text_of(value))``; null, numbers, booleans and plain strings take few steps."""
    return (
        F.when(value.isNull(), "")
        .when(F.ascii(value).isin(1, 2), F.substring(value, 2, 2**31 - 1))
        .when(value.rlike(_PLAIN), value)
        .otherwise(let(text_of(value), lambda t: let(spaced(t), stripped)))
    )


# Number texts that JSON writes in another way.
_WRITTEN = {"nan": "NaN", "inf": "Infinity", "-inf": "-Infinity"}


# An even number of backslashes: what follows is an escape of its own.
_OWN = r"(?<!\\)((?:\\\\)*)"


def compact_json(value: Column) -> Column:
    """A list or object as compact JSON without marks."""
    text = value
    for name, written in _WRITTEN.items():
        text = F.replace(text, F.lit(f'"\\u0001{name}"'), F.lit(written))
    text = F.regexp_replace(text, r'"\\u000[12]([^"]*)"', "$1")
    strings = F.regexp_replace(text, r'(?<=[\[{,:])"\\u0003', '"')
    for code, letter in zip("123", "ABC"):
        strings = F.regexp_replace(strings, _OWN + r"\\u0003" + letter, r"$1\\u000" + code)
    unmarked = (
        F.when(F.contains(value, F.lit("\\u0003")), strings)
        .when(F.contains(value, F.lit("\\u000")), text).otherwise(value)
    )
    return F.when(F.contains(value, F.lit("\\u00")), let(unmarked, _lower_escapes)).otherwise(value)


def _lower_escapes(json_text: Column) -> Column:
    """Control characters as ``\\u001f``, not ``\\u001F``."""
    out = json_text
    for a, b in [("0", x) for x in "BEF"] + [("1", x) for x in "ABCDEF"]:
        out = F.regexp_replace(out, _OWN + rf"\\u00{a}{b}", rf"$1\\u00{a}{b.lower()}")
    some = F.contains(json_text, F.lit("\\u00"))
    return F.when(some & json_text.rlike(r"\\u00[01][A-F]"), out).otherwise(json_text)


# A string of printable ASCII that JSON writes as it is.
_PLAIN_INSIDE = r'\A[ !#-\[\]-~]++\z'


def json_of(value: Column) -> Column:
    """A value as JSON text with a space after each comma and colon."""
    first = F.ascii(value)
    rest = F.substring(value, 2, 2**31 - 1)
    number = rest
    for name, written in _WRITTEN.items():
        number = F.when(rest == name, written).otherwise(number)
    quoted = let(F.to_json(F.array(text_of(value))), lambda q: F.substring(q, F.lit(2), F.length(q) - 2))
    return (
        F.when(value.isNull(), "null").when(first.isin(ord("["), ord("{")), spaced_json(compact_json(value)))
        .when(first == 1, number).when(first == 2, rest)
        .when(value.rlike(_PLAIN_INSIDE), F.concat(F.lit('"'), value, F.lit('"')))
        .otherwise(let(quoted, _lower_escapes))
    )


# Everything up to and including the next separator that is not inside a string.
_UP_TO_SEPARATOR = r'\G((?:[^",:]++|"(?:[^"\\]++|\\.)*+")*+[,:])'


def spaced_json(c: Column) -> Column:
    """Compact JSON text with one space after each comma and colon outside strings."""
    return F.regexp_replace(c, _UP_TO_SEPARATOR, "$1 ")


def items(value: Column) -> Column:
    """Items of a list as typed text, in order; null for anything else."""
    return F.when(is_list(value), F.from_json(value, "array<string>"))


def fields(value: Column) -> Column:
    """Fields of an object as a map from key to typed text; null for anything else."""
    return F.when(is_object(value), F.from_json(value, "map<string,string>"))


def entries(value: Column) -> Column:
    """Entries of an object or list as (step, value), a step being the key or the position."""
    inside = F.transform(F.map_entries(fields(value)), lambda e: F.struct(e["key"].alias("step"), e["value"].alias("value")))
    listed = F.transform(items(value), lambda v, i: F.struct(i.cast("string").alias("step"), v.alias("value")))
    return F.coalesce(inside, listed)


def joined_items(value: Column) -> Column:
    """Each item of a list as JSON text, joined by ``"; "``; blank if no list."""
    rendered = F.array_join(F.transform(items(value), json_of), "; ")
    return F.coalesce(F.when(value != "[]", rendered), F.lit(""))
