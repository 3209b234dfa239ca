"""Responses made from the outside in: first the flat row that must come out, then a line of
JSON text that has to lead to it. Nothing here reads JSON or applies a record rule."""

import random

from recordlake.schema import (
    FREE_FORM_FIELDS,
    LIST_KEYS,
    OUTPUT_COLUMNS,
    PROGRAM_LEVEL_FIELDS,
    SCALAR_FIELDS,
    SINGLE_KEYS,
)

# JSON literal, the text it must give, whether it counts as filled where that matters, and
# how it must look as an item of a free-form list.
LITERALS = [
    ("null", "", False, "null"), ("true", "true", True, "true"), ("false", "false", False, "false"),
    ("0", "0", False, "0"), ("-0", "0", False, "0"), ("0.0", "0.0", False, "0.0"), ("-0.0", "-0.0", False, "-0.0"),
    ("17", "17", True, "17"), ("-4", "-4", True, "-4"), ("9007199254740993", "9007199254740993", True, "9007199254740993"),
    ("123456789012345678901234567890", "123456789012345678901234567890", True, "123456789012345678901234567890"),
    ("48.0", "48.0", True, "48.0"), ("1.50", "1.5", True, "1.5"), ("0.00010", "0.0001", True, "0.0001"),
    ("0.00001", "1e-05", True, "1e-05"), ("1E4", "10000.0", True, "10000.0"), ("123456789.5", "123456789.5", True, "123456789.5"),
    ("1e15", "1000000000000000.0", True, "1000000000000000.0"), ("1e16", "1e+16", True, "1e+16"),
    ("NaN", "nan", True, "NaN"), ("Infinity", "inf", True, "Infinity"), ("-1e999", "-inf", True, "-Infinity"),
    ('""', "", False, '""'), ('"  "', "", True, '"  "'), ('" a b "', "a b", True, '" a b "'),
    ('"1.2E-4"', "1.2E-4", True, '"1.2E-4"'), ('"false"', "false", True, '"false"'), ('"0"', "0", True, '"0"'),
    ('"{x"', "{x", True, '"{x"'), ('"[1, 2"', "[1, 2", True, '"[1, 2"'), ('"NaN"', "NaN", True, '"NaN"'),
    ('"q\\"q, r: s"', 'q"q, r: s', True, '"q\\"q, r: s"'), ('"back\\\\slash"', "back\\slash", True, '"back\\\\slash"'),
    ('"\\u65e5\\u672c"', "\u65e5\u672c", True, '"\u65e5\u672c"'), ('"\u00e9 \u00df"', "\u00e9 \u00df", True, '"\u00e9 \u00df"'),
    ('"\u3000x\u00a0"', "x", True, '"\u3000x\u00a0"'), ('"\\\\u0001"', "\\u0001", True, '"\\\\u0001"'),
]
# Strings with control characters: cleaned text has spaces; joined codes keep them inside.
CONTROLS = [
    ('"n\\nn"', "n n", "n\nn", '"n\\nn"'), ('"a\\u0001b"', "a b", "a\x01b", '"a\\u0001b"'),
    ('"\\u0003A"', "A", "\x03A", '"\\u0003A"'), ('"x\\u001f\\u0002y"', "x  y", "x\x1f\x02y", '"x\\u001f\\u0002y"'),
]


def scalar(rng):
    """Literal, cleaned text, filled, joined text (not cleaned), free-form text."""
    if rng.random() < 0.1:
        literal, text, joined, free = rng.choice(CONTROLS)
        return literal, text, True, joined.strip(), free
    literal, text, filled, free = rng.choice(LITERALS)
    return literal, text, filled, text, free


def obj(rng, pairs):
    """Object text; sometimes a key appears earlier with a value that must not count."""
    shown = list(pairs)
    rng.shuffle(shown)
    if shown and rng.random() < 0.2:
        shown.insert(0, (rng.choice(shown)[0], rng.choice(["5", "null", '"wrong"', "[]", '{"a":1}'])))
    comma, colon = rng.choice([(",", ":"), (", ", ": ")])
    return "{" + comma.join(f'"{k}"{colon}{v}' for k, v in shown) + "}"


def arr(rng, texts):
    return "[" + rng.choice([",", " , "]).join(texts) + "]"


def free_item(rng, depth=2):
    """Text of any value, and the one form in which it has to be written."""
    kind = rng.randrange(5) if depth else 0
    if kind == 3:
        inside = [free_item(rng, depth - 1) for _ in range(rng.randrange(3))]
        return arr(rng, [t for t, _ in inside]), "[" + ", ".join(w for _, w in inside) + "]"
    if kind == 4:
        inside = [(k, free_item(rng, depth - 1)) for k in rng.sample("abcd", rng.randrange(3))]
        old = [f'"{k}":"old"' for k, _ in inside if rng.random() < 0.3]
        text = "{" + ",".join(old + [f'"{k}":{t}' for k, (t, _) in inside]) + "}"
        # A repeated key stays where it was first, with the value that comes last.
        first = [k for k, _ in inside if f'"{k}":"old"' in old] + [k for k, _ in inside if f'"{k}":"old"' not in old]
        by = dict(inside)
        return text, "{" + ", ".join(f'"{k}": {by[k][1]}' for k in first) + "}"
    literal, _, _, _, free = scalar(rng)
    return literal, free


def record(rng):
    """Text of a record, and the row it must become."""
    row, pairs = dict.fromkeys(OUTPUT_COLUMNS, ""), []
    for f in SCALAR_FIELDS:
        if rng.random() < 0.6:
            literal, row[f], *_ = scalar(rng)
            pairs.append((f, literal))
    if rng.random() < 0.6:
        details = []
        for f in ("firstName", "lastName", "about"):
            literal, row[f], *_ = scalar(rng)
            details.append((f, literal))
        if rng.random() < 0.7:
            contact = []
            for f in ("email", "phone"):
                literal, row[f"contact_{f}"], *_ = scalar(rng)
                contact.append((f, literal))
            details.append(("partnerContact", obj(rng, contact)))
        if rng.random() < 0.7:
            chosen, shown = None, []
            for _ in range(rng.randrange(4)):
                text, default = scalar(rng), scalar(rng)
                shown.append(obj(rng, [("description", text[0]), ("isDefault", default[0])]))
                if chosen is None and text[2] and default[2]:
                    chosen = text[1]
            row["description"] = chosen or ""
            details.append(("descriptions", arr(rng, shown)))
        pairs.append(("partnerDetails", obj(rng, details)))
    if rng.random() < 0.6:
        kinds = [(scalar(rng), scalar(rng)) for _ in range(rng.randrange(4))]
        row["businessType_codes"] = "; ".join(c[3] for c, _ in kinds if c[2])
        row["businessType_names"] = "; ".join(n[3] for _, n in kinds if n[2])
        pairs.append(("businessType", arr(rng, [obj(rng, [("code", c[0]), ("name", n[0])]) for c, n in kinds])))
    if rng.random() < 0.5:
        levels = []
        for i in range(rng.randrange(3)):
            level = {name: scalar(rng) for name in PROGRAM_LEVEL_FIELDS}
            if i == 0:
                row |= {name: v[1] for name, v in level.items()}
            levels.append(obj(rng, [(PROGRAM_LEVEL_FIELDS[name], v[0]) for name, v in level.items()]))
        pairs.append(("programLevels", arr(rng, levels)))
    for f in FREE_FORM_FIELDS:
        if rng.random() < 0.4:
            found = [free_item(rng) for _ in range(rng.randrange(4))]
            row[f] = "; ".join(w for _, w in found)
            pairs.append((f, arr(rng, [t for t, _ in found])))
    return obj(rng, pairs), row


NO_RECORD = ["5", '"{x"', "null", "[1]", "true", '"{\\"id\\":1}"']


def line(rng):
    """A raw line and its rows by place in the list."""
    items, rows = [], {}
    for _ in range(rng.randrange(1, 4)):
        if rng.random() < 0.15:
            items.append(rng.choice(NO_RECORD))
            continue
        text, row = record(rng)
        rows[len(items)] = row
        items.append(text)
    body = arr(rng, items)
    kind = rng.randrange(3)
    if kind == 1:  # under the first filled list key; later ones and other values do not count
        at = rng.randrange(len(LIST_KEYS))
        before = [(k, rng.choice(["[]", "null", "3", '{"id":1}', '"[1]"'])) for k in LIST_KEYS[:at] if rng.random() < 0.3]
        after = [(k, '[{"id":"later"}]') for k in LIST_KEYS[at + 1 :] if rng.random() < 0.3]
        body = "{" + ",".join(f'"{k}":{v}' for k, v in [*after, *before, (LIST_KEYS[at], body)]) + "}"
    elif kind == 2:  # a single record, known by one of its keys
        text, row = record(rng)
        key = rng.choice(SINGLE_KEYS)
        value = '"kept"' if key in SCALAR_FIELDS else "1"
        body, rows = text[:-1] + ("," if len(text) > 2 else "") + f'"{key}":{value}' + "}", {0: row}
        if key in SCALAR_FIELDS:
            row[key] = "kept"
    # Any object without "body" of its own may also stand alone on the line.
    return rng.choice([body, f'{{"url":"u","body":{body}}}', f'{{"body":5,"body":{body},"n":1}}']), rows


def lines(seed, n):
    rng = random.Random(seed)
    return [line(rng) for _ in range(n)]
