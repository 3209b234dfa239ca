"""Leaf texts: random trees written with and without the end tags that may be left out."""

import random

import pytest

from recordlake.functions.html import leaf_elements

PHRASING = ["b", "span", "a", "i"]


def inline(rng, depth):
    if depth > 2 or rng.random() < 0.5:
        return rng.choice(["text 123", "&amp; 9", " ", "x < 5"]) if rng.random() < 0.8 else ("br", [])
    return (rng.choice(PHRASING), [inline(rng, depth + 1) for _ in range(rng.randrange(3))])


def block(rng, depth=0):
    """A tree: text, or (name, children)."""
    kind = rng.choice(["p", "ul", "table", "dl", "div", "text", "raw"]) if depth < 4 else rng.choice(["p", "text"])
    if kind == "text":
        return inline(rng, 0)
    if kind == "raw":
        return (rng.choice(["script", "style"]), ["if (a<b) '<p>' 777"])
    if kind == "p":
        return ("p", [inline(rng, 0) for _ in range(rng.randrange(1, 4))])
    if kind == "div":
        return ("div", [block(rng, depth + 1) for _ in range(rng.randrange(3))])

    def inside(name):
        return (name, [block(rng, depth + 1) for _ in range(rng.randrange(3))])

    if kind == "ul":
        return ("ul", [inside("li") for _ in range(rng.randrange(4))])
    if kind == "dl":
        return ("dl", [inside(rng.choice(["dt", "dd"])) for _ in range(rng.randrange(4))])
    rows = [("tr", [inside(rng.choice(["td", "th"])) for _ in range(rng.randrange(3))]) for _ in range(rng.randrange(3))]
    return ("table", [("tbody", rows)] if rng.random() < 0.5 else rows)


MAY_END_ALONE = {"li": ["li"], "dt": ["dt", "dd"], "dd": ["dt", "dd"], "td": ["td", "th"], "th": ["td", "th"], "tr": ["tr"],
                 "p": ["p", "ul", "table", "dl", "div"]}


def write(rng, nodes, leave_out, at_end):
    """Markup of sibling nodes; ``at_end`` tells that the end of their parent is written."""
    out = []
    for k, node in enumerate(nodes):
        if isinstance(node, str):
            out.append(node)
            continue
        name, children = node
        out.append(f"<{name.upper() if rng.random() < 0.2 else name}{rng.choice(['', ' id=x', ' title=a>b'[:8], ' t=\"a>b\"'])}>")
        if name == "br":
            continue
        after = nodes[k + 1] if k + 1 < len(nodes) else None
        followed = at_end if after is None else (not isinstance(after, str) and after[0] in MAY_END_ALONE.get(name, []))
        open_ = name in MAY_END_ALONE and followed and rng.random() < leave_out
        out.append(write(rng, children, leave_out, True))
        if not open_:
            out.append(f"</{name}>")
        if rng.random() < 0.1 and name not in ("li", "td", "th", "tr", "dt", "dd") and not open_:
            out.append("<!-- 4711 <p> -->")
    return "".join(out)


def leaves(nodes):
    found = []
    for node in nodes:
        if not isinstance(node, str) and node[0] != "br":
            children = node[1]
            if all(isinstance(c, str) for c in children):
                found.append("".join(children))
            else:
                found += leaves(children)
    return found


@pytest.mark.parametrize("leave_out", [0.0, 0.5, 1.0])
def test_leaves_of_random_trees(leave_out):
    for seed in range(400):
        rng = random.Random(seed)
        tree = [("div", [block(rng) for _ in range(rng.randrange(1, 5))])]
        page = write(rng, tree, leave_out, True)
        assert leaf_elements(page) == leaves(tree), page


def test_odd_pages():
    assert leaf_elements(None) == leaf_elements("") == leaf_elements("no markup 123") == []
    assert leaf_elements("<p>a<p>b") == ["a", "b"]
    assert leaf_elements("<ul><li>1<ul><li>2</ul><li>3</ul>") == ["2", "3"]
    assert leaf_elements("</div><b>x</i></b></b>") == ["x"]
    assert leaf_elements("<table><tr><td>1</div><td>2</table><p>3") == ["1", "2", "3"]
    assert leaf_elements("<script>never closed <p>") == ["never closed <p>"]
    assert leaf_elements("<title>&lt;x&gt;</title><!DOCTYPE html><!-- <p>no</p> --><p/>y") == ["&lt;x&gt;", "y"]
    assert leaf_elements("<p title='it''s'>q<!-- open") == ["q"]
    assert len(leaf_elements("<li>" * 20000 + "x")) == 20000
    assert leaf_elements("<" * 50000 + "a") == []
