"""DuckDB statements for the registered queries that SQL can express."""

from __future__ import annotations

# Per turn: header "### ", role, ": ", text, "</turn>", line feed; one more sign per escape.
OP8 = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), sized AS (
  SELECT *, 4 + length(role) + 2 + length(text) + 8
    + length(text) - length(replace(text, '\', ''))
    + (length(text) - length(replace(text, '###', ''))) // 3
    + (length(text) - length(replace(text, '</turn>', ''))) // 7
    + length(role) - length(replace(replace(role, '\', ''), ':', ''))
    + (length(role) - length(replace(role, '###', ''))) // 3
    + (length(role) - length(replace(role, '</turn>', ''))) // 7 AS formatted
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(formatted) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""

_NEAREST = """
{name} AS MATERIALIZED (
  SELECT rid, part, e, d FROM (
    SELECT c.rid, c.part, b.e, sum((c.x - b.x) * (c.x - b.x)) AS d,
      row_number() OVER (PARTITION BY c.rid, c.part ORDER BY sum((c.x - b.x) * (c.x - b.x)), b.e) AS place
    FROM cut c JOIN {books} b ON c.part = b.part AND c.pos = b.pos GROUP BY c.rid, c.part, b.e
  ) WHERE place = 1
)"""
_MEANS = """
book{k} AS MATERIALIZED (
  SELECT b.part, b.e, b.pos, coalesce(m.x, b.x) AS x FROM {books} b LEFT JOIN (
    SELECT n.part, n.e, c.pos, CAST(floor(CAST(sum(c.x) AS DOUBLE) / count(*)) AS BIGINT) AS x
    FROM near{k} n JOIN cut c ON n.rid = c.rid AND n.part = c.part GROUP BY n.part, n.e, c.pos
  ) m ON b.part = m.part AND b.e = m.e AND b.pos = m.pos
)"""
_ROUNDS = ",".join(
    _NEAREST.format(name=f"near{k}", books=f"book{k - 1}") + "," + _MEANS.format(k=k, books=f"book{k - 1}")
    for k in range(1, 7)
)
# Vectors of 64 components, eight to a part.
OP11 = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, label, embedding FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), cut AS MATERIALIZED (
  SELECT rid, vec_id, (i - 1) // 8 AS part, (i - 1) % 8 AS pos,
    CAST(floor(4096 * CAST(embedding[i] AS DOUBLE)) AS BIGINT) AS x
  FROM (SELECT rid, vec_id, embedding, unnest(range(1, 65)) AS i FROM kept)
), seeds AS (
  SELECT min(rid) AS rid, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept GROUP BY vec_id ORDER BY vec_id LIMIT 16
), book0 AS MATERIALIZED (SELECT part, e, pos, x FROM cut JOIN seeds USING (rid)),
{_ROUNDS},
{_NEAREST.format(name="final", books="book6")},
coded AS (
  SELECT rid, string_agg(lpad(lower(to_hex(e)), 2, '0'), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM final GROUP BY rid
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, e, pos)) FROM book6) AS codebooks_sha256
FROM coded JOIN kept USING (rid)
"""

# crc32 of a text of ASCII characters: per character its code, then eight shifts.
_CRC = """xor(4294967295, list_reduce(list_concat([4294967295], flatten(list_transform(
  range(1, length({s}) + 1), lambda i: [ord(substr({s}, i, 1)), -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END))"""
# A node is named by the digests of its turns, 32 letters each.
OP13 = f"""
WITH turns AS MATERIALIZED (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS no
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS MATERIALIZED (
  SELECT conv_id, {_CRC.format(s="CAST(conv_id AS VARCHAR)")} % 6 AS h FROM (SELECT DISTINCT conv_id FROM turns)
), rebuilt AS (
  SELECT c.conv_id, t.no, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id - c.conv_id % 100 AND t.no <= c.h
  UNION ALL SELECT c.conv_id, t.no, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.no > c.h
), numbered AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY no) AS depth, text,
    md5(length(role) || ':' || role || text) AS mark FROM rebuilt
), steps AS MATERIALIZED (
  SELECT conv_id, 0 AS depth, '' AS node, 0 AS chars FROM convs
  UNION ALL SELECT conv_id, depth, string_agg(mark, '') OVER (PARTITION BY conv_id ORDER BY depth), length(text) FROM numbered
), nodes AS MATERIALIZED (
  SELECT node, max(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(chars) AS saved,
    left(node, greatest(0, length(node) - 32)) AS parent FROM steps GROUP BY node
), children AS (SELECT parent AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY parent),
below AS (
  SELECT left(n.node, 32 * up) AS node, sum(saved) AS saved_tokens, count(*) FILTER (WHERE leaf) AS n_leaves
  FROM (SELECT node, saved, node NOT IN (SELECT node FROM children) AS leaf, unnest(range(0, depth + 1)) AS up FROM nodes) n
  GROUP BY 1
), ends AS (
  SELECT node, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS ends_sha256
  FROM steps s WHERE depth = (SELECT max(depth) FROM steps t WHERE t.conv_id = s.conv_id) GROUP BY node
)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, CASE WHEN n.depth > 0 THEN p.conv_id END AS parent_conv_id, n.n_convs,
  coalesce(c.n_children, 0) AS n_children, b.n_leaves, CAST(b.saved_tokens AS BIGINT) AS saved_tokens,
  coalesce(e.ends_sha256, sha256('')) AS ends_sha256
FROM nodes n LEFT JOIN nodes p ON n.parent = p.node LEFT JOIN children c ON n.node = c.node
  JOIN below b ON n.node = b.node LEFT JOIN ends e ON n.node = e.node
"""

ORACLE: dict[str, str] = {"op8_chat": OP8, "op11_codes": OP11, "op13_prefix_trie": OP13}
