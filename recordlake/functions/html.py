"""Leaf texts of HTML pages, with a stack of open elements over the stream of tags.

Pages leave out end tags that a browser supplies: a list item ends where the next one begins,
a paragraph where a block begins, a cell where a row begins. The stack closes them by the same
rules, so elements without child elements are found whether they were closed or not.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

# --- fixed values: elements without content; elements whose content is no markup -----
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title".split())

# --- fixed values: start tags that end an open paragraph -------------------------------
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr li main menu nav ol p pre section table ul".split()
)

# --- fixed values: start tag -> open elements that it ends, and those that shield them ---
_CELLS, _ROWS = {"td", "th"}, {"tr", "td", "th"}
_GROUPS = {"tbody", "thead", "tfoot", "caption", "colgroup"} | _ROWS
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist", "optgroup"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": (_CELLS, {"tr", "table"}), "th": (_CELLS, {"tr", "table"}), "tr": (_ROWS, {"table", "tbody", "thead", "tfoot"}),
    **dict.fromkeys(["tbody", "thead", "tfoot"], (_GROUPS, {"table"})),
    "body": ({"head"}, set()),
}
_PARAGRAPH = ({"p"}, {"button", "table", "td", "th", "caption", "object", "template"})
# An end tag inside one of these does not reach what is around it.
_WALLS = frozenset(["table", "td", "th", "caption", "template"])
_TABLE_TAGS = frozenset(["table", *_GROUPS])

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)[^>]*+>",
    re.S,
)


class _Element:
    __slots__ = ("name", "texts", "has_child")

    def __init__(self, name: str):
        self.name, self.texts, self.has_child = name, [], False


def _close(stack: list[_Element], wanted, walls) -> None:
    """End the outermost open element of ``wanted`` above a wall, and all inside it."""
    found = None
    for i in range(len(stack) - 1, -1, -1):
        if stack[i].name in wanted:
            found = i
        elif stack[i].name in walls:
            break
    if found is not None:
        del stack[found:]


def leaf_elements(page: str | None) -> list[str]:
    """Texts of all elements without child elements, in the order of their start tags.

    Character references and white space stay as they are; void elements have no text; what
    is open at the end of the page ends there.
    """
    page = page or ""
    every: list[_Element] = []
    stack: list[_Element] = []
    at = 0

    def begin(name: str) -> _Element:
        if stack:
            stack[-1].has_child = True
        return _Element(name)

    while at < len(page):
        token = _TOKEN.search(page, at)
        text = page[at : token.start()] if token else page[at:]
        if text and stack:
            stack[-1].texts.append(text)
        if token is None:
            break
        at = token.end()
        name = (token[2] or token[5] or "").lower()
        if not name:
            continue
        if token[1] or token[4]:
            # The innermost one of that name; parts of a table are not looked for outside it.
            walls = {"table"} if name in _TABLE_TAGS else _WALLS
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].name == name:
                    del stack[i:]
                    break
                if stack[i].name in walls:
                    break
            continue
        if name in ENDS_PARAGRAPH:
            _close(stack, *_PARAGRAPH)
        if name in ENDS:
            _close(stack, *ENDS[name])
        element = begin(name)
        if name in VOID:
            continue
        every.append(element)
        if name in RAW:
            end = re.compile(rf"</{name}\s*>", re.I).search(page, at)
            element.texts.append(page[at : end.start()] if end else page[at:])
            at = end.end() if end else len(page)
        else:
            stack.append(element)
    return ["".join(e.texts) for e in every if not e.has_child]


@F.arrow_udf(ArrayType(StringType()))
def leaf_element_texts(pages: pa.Array) -> pa.Array:
    return pa.array([leaf_elements(p) for p in pages.to_pylist()], pa.list_(pa.string()))
