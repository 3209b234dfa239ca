"""DuckDB counterparts of the edge queries, from the flat tables."""

from __future__ import annotations

from recordlake.schema import OUTPUT_COLUMNS

_MARKS = "|| ' ref AB-' || {k} % 500 || ' ' || lpad({k}::VARCHAR, 24, '7') || ' é' || {k} % 500"


def _known(source: str, key: str, body: str) -> str:
    return f"""
      WITH texts AS (SELECT {key} % 3 AS "group", {body} {_MARKS.format(k=key)} AS text FROM {source}),
      ids AS (SELECT DISTINCT unnest(['AB-' || s_suppkey, lpad(s_suppkey::VARCHAR, 24, '7'), '-' || s_suppkey,
        ' é' || s_suppkey]) AS id FROM supplier)
      SELECT "group", id AS known_id, (strpos(text, id) - 1)::INT AS "at",
        substring(text, greatest(1, strpos(text, id) - 50), strpos(text, id) + 100 - greatest(1, strpos(text, id) - 50))
          AS snippet
      FROM texts JOIN ids ON contains(text, id)"""


_KEPT = """SELECT DISTINCT (c_custkey % 400)::VARCHAR AS id, c_mktsegment AS city FROM customer"""
_COPY = {c: "''" for c in OUTPUT_COLUMNS} | {
    "id": "id", "companyName": "'Firm'", "city": "city", "country": "'X'", "webSite": "'0'", "about": "'copy 0'",
}
_COPIES = f"""SELECT {", ".join(f'{v} AS "{c}"' for c, v in _COPY.items())} FROM ({_KEPT})"""
# Per nation five lines; its bare name is no JSON.
_JUNK = "SELECT n_name FROM nation"
_LENIENT = """CASE event_type WHEN 'view' THEN '{''id'':1}' WHEN 'click' THEN '[{"id":1}]x'
  WHEN 'error' THEN '{"body":[{"id":1,}]}' WHEN 'purchase' THEN '[{"id":NaN},{"id":2}]'
  ELSE '"a' || chr(9) || 'b"' END"""

_LINE_NUMBERS = """
      SELECT 'priority=' || left(o_orderpriority, 1) AS folder,
        row_number() OVER (PARTITION BY left(o_orderpriority, 1) ORDER BY o_orderkey) AS line_no,
        '{"id":' || o_orderkey || '}' AS value FROM orders"""

EDGE_ORACLE: dict[str, str] = {
    "line_numbers": _LINE_NUMBERS,
    "stream_line_numbers": _LINE_NUMBERS,
    "repeated_keys": """
      SELECT 1 AS pos, p_partkey::VARCHAR AS id, p_name AS city,
        '{"a": ' || p_size || '}; "{\\"a\\":1,\\"a\\":2}"' AS competence, p_name AS "businessType_codes"
      FROM part""",
    "scalar_texts": """
      SELECT l_orderkey, l_linenumber, l_orderkey::VARCHAR AS id, (l_orderkey || 'e-7')::DOUBLE::VARCHAR AS latitude,
        'nan' AS longitude, l_orderkey || '.0' AS "productCount", (l_orderkey || 'e12')::DOUBLE::VARCHAR AS "idGroup",
        '1.0E10' AS "stateId", l_orderkey || 'e-7' AS "zipCode", 'true' AS eshop, 'true' AS "emailExists",
        '-0.0001' AS address1, ('1' || l_orderkey || '5000000.5')::DOUBLE::VARCHAR AS address2, '-inf' AS city,
        (l_orderkey || 'e-7')::DOUBLE::VARCHAR || '; 1.5; "1.50"; [' || (l_orderkey || 'e12')::DOUBLE::VARCHAR || ']'
          AS competence
      FROM lineitem""",
    "lenient_attempts": f"""
      SELECT event_id AS batch_idx, CASE event_type WHEN 'purchase' THEN 'success' ELSE 'parse_error' END AS outcome,
        CASE event_type WHEN 'purchase' THEN 2 ELSE 0 END AS n_records,
        CASE WHEN event_type <> 'purchase' THEN {_LENIENT} END AS preview FROM events""",
    "rejected_lines": f"""
      SELECT event_id, CASE WHEN event_id % 2 = 0 THEN '{{"body":' || {_LENIENT} || '}}' ELSE {_LENIENT} END AS line
      FROM events WHERE event_type <> 'purchase'""",
    "session_elapsed_nulls": """
      WITH e AS (SELECT event_id, ts, CASE WHEN user_id % 7 <> 0 THEN user_id END AS session FROM events)
      SELECT event_id, session, epoch_us(ts) - epoch_us(min(ts) OVER (PARTITION BY session)) AS elapsed_us FROM e""",
    "late_attempts": """
      SELECT batch_idx, coalesce(stop_with, 'FAILED') AS final_status, (coalesce(stop_at, last_at) + 1)::BIGINT AS attempts_made,
        (coalesce(stop_with, '') = 'success')::BIGINT AS n_records,
        2.0::DOUBLE * (pow(2, coalesce(stop_at, last_at)) - 1) AS wait_seconds
      FROM (<BATCHES>) WHERE batch_idx % 2 = 1
      UNION ALL SELECT DISTINCT conv_id, 'FAILED', 4, 0, 14.0::DOUBLE FROM conversations WHERE conv_id % 2 = 0""",
    "delta_null_ids": """
      SELECT CASE WHEN c_custkey <> 1 THEN c_custkey END AS id, 'changed' AS change, 'companyName' AS changed_columns
      FROM customer WHERE c_mktsegment = 'BUILDING'""",
    "json_blank_country": """
      SELECT c_custkey::VARCHAR AS id,
        CASE WHEN c_mktsegment = 'BUILDING' THEN '' WHEN c_mktsegment <> 'FURNITURE' THEN n_name END AS country,
        CASE WHEN c_mktsegment IN ('BUILDING', 'FURNITURE') THEN '(blank)' ELSE n_name END AS results
      FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "alias_beside_name": """
      SELECT c_name AS name, lower(n_name) AS country FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "known_ids_any_kind": _known("documents", "doc_id", "text"),
    "known_ids_joined": _known("customer", "c_custkey", "c_name"),
    "run_records": _COPIES,
    "stream_equals_batch": _COPIES,
    "stream_first_arrivals": "SELECT min(event_id) AS event_id, user_id, event_type FROM events GROUP BY user_id, event_type",
    "stream_progress": """
      SELECT unnest(['unique', 'reports', 'last']) AS name, unnest([n, n // 200, n // 200 * 200]) AS n
      FROM (SELECT count(*) AS n FROM (SELECT DISTINCT user_id, event_type FROM events))""",
    "csv_in_splits": """SELECT doc_id::VARCHAR AS doc_id, md5(replace(coalesce(text, ''), 'e', '"' || chr(10))) AS text FROM documents""",
    "frequent_words": """SELECT word, count(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents)
      WHERE word <> '' GROUP BY word ORDER BY n DESC, word LIMIT 20""",
    "frequent_keys": """SELECT l_orderkey::VARCHAR AS key, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, key LIMIT 20""",
    "ids_over_runs": """
      WITH r AS (SELECT c_custkey AS id FROM customer UNION ALL SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0
        UNION ALL SELECT c_custkey FROM customer WHERE c_custkey % 3 = 0)
      SELECT 3::BIGINT AS n_runs, count(*) AS n_rows, count(DISTINCT id) AS distinct_ids,
        count(*) - count(DISTINCT id) AS duplicate_ids, true AS exact, 0::BIGINT AS error,
        count(*) FILTER (WHERE id % 5 > 0) AS n_filled FROM r""",
    "merged_schema": """
      WITH c AS (SELECT count(*) AS n, count(*) FILTER (WHERE o_orderkey % 3 = 0) AS n0,
        count(*) FILTER (WHERE o_orderkey % 3 = 1) AS n1, count(*) FILTER (WHERE o_orderkey % 3 = 2) AS n2 FROM orders),
      p AS (SELECT unnest([
        {'path': '$', 'o': n, 'a': 0, 's': 0, 'i': 0, 'd': 0, 'b': 0, 'z': 0, 'above': 0},
        {'path': '$.id', 'o': 0, 'a': 0, 's': 0, 'i': n, 'd': 0, 'b': 0, 'z': 0, 'above': n},
        {'path': '$.status', 'o': 0, 'a': 0, 's': n1 + n2, 'i': 0, 'd': 0, 'b': 0, 'z': n0, 'above': n},
        {'path': '$.tags', 'o': 0, 'a': n, 's': 0, 'i': 0, 'd': 0, 'b': 0, 'z': 0, 'above': n},
        {'path': '$.tags[]', 'o': 2 * n1, 'a': 0, 's': n1, 'i': 0, 'd': 0, 'b': 0, 'z': 0, 'above': 0},
        {'path': '$.tags[].a', 'o': 0, 'a': 0, 's': 0, 'i': n1, 'd': 0, 'b': 0, 'z': n1, 'above': 2 * n1},
        {'path': '$.tags[]["b c"]', 'o': 0, 'a': 0, 's': 0, 'i': 0, 'd': n1, 'b': 0, 'z': 0, 'above': 2 * n1},
        {'path': '$.note', 'o': n2, 'a': 0, 's': 0, 'i': 0, 'd': 0, 'b': 0, 'z': 0, 'above': n},
        {'path': '$.note.deep', 'o': 0, 'a': n2, 's': 0, 'i': 0, 'd': 0, 'b': 0, 'z': 0, 'above': n2},
        {'path': '$.note.deep[]', 'o': 0, 'a': n2, 's': 0, 'i': 0, 'd': 0, 'b': 0, 'z': 0, 'above': 0},
        {'path': '$.note.deep[][]', 'o': 0, 'a': 0, 's': 0, 'i': 0, 'd': 0, 'b': n2, 'z': 0, 'above': 0}]) AS v FROM c),
      t AS (SELECT v.*, v.o + v.a + v.s + v.i + v.d + v.b + v.z AS n_values FROM p)
      SELECT path, concat_ws('|', CASE WHEN o > 0 THEN 'object' END, CASE WHEN a > 0 THEN 'array' END,
          CASE WHEN s > 0 THEN 'string' END, CASE WHEN i > 0 THEN 'bigint' END, CASE WHEN d > 0 THEN 'double' END,
          CASE WHEN b > 0 THEN 'boolean' END) AS kinds, z > 0 AS nullable, n_values < above AS optional, n_values,
        o AS n_object, a AS n_array, s AS n_string, i AS n_bigint, d AS n_double, b AS n_boolean, z AS n_null FROM t""",
    "run_rejects": f"{_JUNK} UNION ALL {_JUNK}".replace("n_name FROM", "n_name AS line FROM"),
    "run_counts": f"""
      SELECT unnest(['parsed', 'unique', 'rejected', 'missing', 'failed_batches', 'exported']) AS name, unnest([
        (SELECT 2 * count(*) FROM customer), (SELECT count(*) FROM ({_KEPT})), (SELECT 2 * count(*) FROM nation),
        (SELECT count(*) FROM customer WHERE c_custkey NOT IN (SELECT id::BIGINT FROM ({_KEPT}))),
        (SELECT count(*) FROM (<BATCHES>) WHERE stop_with IS NULL), (SELECT count(*) FROM ({_KEPT}))]) AS n""",
    "empty_run": """
      SELECT 0::BIGINT AS parsed, 0::BIGINT AS "unique", count(*) AS rejected, 0::BIGINT AS reports FROM nation""",
    "page_files": "SELECT html || chr(10) AS text FROM pages",
    "traffic_file": """
      SELECT event_id::DOUBLE AS t, method, stable_url || '&ts=' || event_id AS url, status,
        CASE WHEN event_type IN ('view', 'purchase', 'error') THEN 'application/json'
          WHEN event_type = 'click' THEN 'text/javascript' ELSE 'text/html' END AS content_type, body
      FROM (<TRAFFIC>)""",
    "stamped_runs": """
      SELECT c_custkey AS id, '20240101_000000' AS run_ts FROM customer
      UNION ALL SELECT s_suppkey, '20240102_000000' FROM supplier""",
    "format_round_trip": """
      SELECT unnest(['parquet', 'orc', 'json', 'csv']) AS fmt, p_partkey::VARCHAR AS id, 'a"b, ' || p_name AS name
      FROM part""",
    "export_round_trip": """
      SELECT '"id","city"' AS value UNION ALL SELECT '"' || n_nationkey || '","' || n_name || '"' FROM nation""",
}
