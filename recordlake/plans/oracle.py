"""The registered queries as DuckDB SQL over the flat tables, never through JSON.

Each statement states the expected answer from the base columns, so it shares neither
code nor intermediate data with the Spark side.
"""

from __future__ import annotations

from recordlake.functions.text import WHITESPACE
from recordlake.plans.edge_oracle import EDGE_ORACLE
from recordlake.plans.queries import (
    COUNTRY_ALIASES,
    HREF,
    MARK,
    PAGE_KEYWORDS,
    PATH_KEYWORDS,
    TEXT_KEYWORDS,
)
from recordlake.schema import OUTPUT_COLUMNS, PII_COLUMNS

SPACES = "||".join(f"chr({ord(c)})" for c in WHITESPACE)


def strip(x: str) -> str:
    return f"trim({x}, {SPACES})"


def clean(x: str) -> str:
    return strip(rf"regexp_replace(coalesce({x}, ''), '[\x00-\x1f\x7f]', ' ', 'g')")


def quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def joined(x: str) -> str:
    return f"array_to_string({x}, ',')"


# --- customers: the 39 columns straight from the tables -----------------------------------

CUSTOMERS = """customer
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey"""

POSITIVE = "c_acctbal > 0"


def if_positive(x: str) -> str:
    return f"CASE WHEN {POSITIVE} THEN {x} ELSE '' END"


CUSTOMER_COLUMNS = {c: "''" for c in OUTPUT_COLUMNS} | {
    "id": "c_custkey::VARCHAR",
    "accountBfoId": "'BFO-' || c_custkey",
    "companyName": "c_name",
    "address1": "c_custkey || ' ' || r_name || ' Street'",
    "city": "'City ' || c_nationkey",
    "zipCode": "lpad(c_custkey::VARCHAR, 9, '0')",
    "administrativeRegion": "r_name",
    "country": "n_name",
    "countryId": "n_nationkey::VARCHAR",
    "latitude": "c_acctbal::VARCHAR",
    "longitude": """CASE c_mktsegment WHEN 'BUILDING' THEN 'n/a' WHEN 'FURNITURE' THEN ''
      WHEN 'HOUSEHOLD' THEN '12.5' WHEN 'MACHINERY' THEN '1e3' ELSE c_acctbal::VARCHAR END""",
    "webSite": "'https://example.org/' || c_custkey",
    "contact_email": if_positive("'mail' || c_custkey || '@example.org'"),
    "firstName": if_positive("upper(c_mktsegment[1:1]) || lower(c_mktsegment[2:])"),
    "about": if_positive("c_name || ' of ' || r_name"),
    "description": if_positive("lower(c_mktsegment)"),
    "emailExists": f"({POSITIVE})::VARCHAR",
    "phoneExists": "'false'",
    "eshop": "(c_mktsegment = 'BUILDING')::VARCHAR",
    "openingHoursType": "lower(c_mktsegment)",
    "productCount": "c_nationkey::VARCHAR",
    "businessType_codes": "c_mktsegment[1:3] || '; false'",
    "businessType_names": "c_mktsegment || '; Trade'",
    "programLevel_globalId": if_positive("r_name"),
    "programLevel_displayRank": if_positive("n_regionkey::VARCHAR"),
    "programLevel_b2cAvailable": if_positive("'true'"),
    "openingHours": """'{"day": "' || n_name || '", "open": ' || c_nationkey || '}'""",
}


def customers(columns=OUTPUT_COLUMNS, where: str = "") -> str:
    listed = ", ".join(f'{CUSTOMER_COLUMNS[c]} AS "{c}"' for c in columns)
    return f"SELECT {listed} FROM {CUSTOMERS} {where}"


FILLED_COLUMNS = [c for c in OUTPUT_COLUMNS if CUSTOMER_COLUMNS[c] != "''"]

FILL_RATES = " UNION ALL ".join(
    f"SELECT {i} AS col_pos, '{c}' AS column_name, count(*) FILTER ({strip(chr(34) + c + chr(34))} <> '') AS n_filled,"
    " count(*) AS n FROM flat"
    for i, c in enumerate(OUTPUT_COLUMNS)
)

# --- documents by line -----------------------------------------------------------------------

LINES = "string_split(text, chr(10))"
DOC_CODES = f"array_to_string([{strip('x')} FOR x IN {LINES} IF x <> ''], '; ')"
DOC_NAMES = f"array_to_string([{strip('x')} FOR x IN {LINES}], '; ')"
DOC_DESCRIPTION = clean(f"[x FOR x IN {LINES} IF contains(x, ',')][1]")

DOCUMENT_COLUMNS = {c: "''" for c in OUTPUT_COLUMNS} | {
    "id": "doc_id::VARCHAR",
    "country": clean("lang"),
    "city": clean("source"),
    "companyName": clean("text"),
    "description": DOC_DESCRIPTION,
    "businessType_codes": DOC_CODES,
    "businessType_names": DOC_NAMES,
}

# --- attempts from conversations ---------------------------------------------------------------

ATTEMPTS = """
  SELECT conv_id AS batch_idx, turn AS attempt,
    CASE WHEN role = 'system' THEN 'network_error' WHEN role = 'user' THEN 'server_error'
      WHEN contains(text, chr(10)) THEN 'success' WHEN contains(text, ',') THEN 'empty'
      ELSE 'parse_error' END AS outcome,
    CASE WHEN role = 'user' THEN text[1:120]
      WHEN role = 'assistant' AND NOT contains(text, chr(10)) AND contains(text, ',') THEN '{"items":[]}'
      WHEN role = 'assistant' AND NOT contains(text, chr(10)) THEN text[1:100] END AS preview
  FROM conversations"""

BATCHES = f"""
  SELECT batch_idx, min(attempt) FILTER (outcome IN ('success', 'empty')) AS stop_at,
    arg_min(outcome, attempt) FILTER (outcome IN ('success', 'empty')) AS stop_with,
    max(attempt) AS last_at
  FROM ({ATTEMPTS}) WHERE attempt <= 3 GROUP BY batch_idx"""

# --- traffic from events ---------------------------------------------------------------------------

TRAFFIC = """
  SELECT event_id, ts, user_id, event_type,
    CASE WHEN event_type IN ('purchase', 'signup') THEN 'POST' ELSE 'GET' END AS method,
    'https://example.org/api/' || event_type || '?countryCode=' || user_id AS stable_url,
    CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status,
    CASE event_type WHEN 'view' THEN props WHEN 'click' THEN '[' || props || ',' || props || ']'
      WHEN 'error' THEN '{"code":"E' || user_id || '","detail":null}'
      WHEN 'purchase' THEN '{"count":' || user_id || ',"ids":[1,2,' || user_id || ']}'
      ELSE 'signup of ' || user_id END AS body
  FROM events"""

SHAPE = """CASE event_type WHEN 'click' THEN 'list' WHEN 'signup' THEN 'raw' ELSE 'object' END"""

# --- embeddings as whole numbers ---------------------------------------------------------------------

VECTORS = "SELECT vec_id, label, [floor(x::DOUBLE * 1000)::BIGINT FOR x IN embedding] AS v FROM embeddings"

# --- keyword hits -------------------------------------------------------------------------------------


def keyword_hits(table, key, text, keywords, before, after, cap, most) -> str:
    parts = " UNION ALL ".join(
        f"SELECT {key}, {text} AS t, {i} AS keyword_pos, {quoted(k)} AS keyword,"
        f" strpos({text}, {quoted(k)}) AS p FROM {table}"
        for i, k in enumerate(keywords)
    )
    limit = f"QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY keyword_pos) <= {most}" if most else ""
    return f"""
    SELECT {key}, keyword_pos, keyword, (p - 1)::INT AS "at",
      substring(t, greatest(1, p - {before}), least(p + {after} - greatest(1, p - {before}), {cap})) AS snippet
    FROM ({parts}) WHERE p > 0 {limit}"""


HREFS = f"regexp_extract_all(html, {quoted(HREF)}, 1)"

RAW_TEXT = "|".join(rf"<{t}\b[^>]*>.*?</{t}\s*>" for t in ("script", "style", "title", "textarea"))
LEAF = rf"(?is){RAW_TEXT}|<[a-z][a-z0-9]*\b[^>]*>[^<]*</[a-z][a-z0-9]*\s*>"
LEAF_TEXT = r"""regexp_extract(m, '(?is)^<[a-z][a-z0-9]*\b[^>]*>(.*)</[a-z0-9]+\s*>$', 1)"""
for _name, _char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " "), ("&amp;", "&")):
    LEAF_TEXT = f"replace({LEAF_TEXT}, '{_name}', '{_char}')"
LEAF_TEXT = strip(LEAF_TEXT)
OPEN_NAME = r"lower(regexp_extract(m, '(?i)^<([a-z][a-z0-9]*)', 1))"
CLOSE_NAME = r"lower(regexp_extract(m, '(?i)</([a-z][a-z0-9]*)\s*>$', 1))"

SUPPLIER_LISTED = "SELECT * FROM supplier WHERE s_acctbal >= 0"

ALIAS_CASE = " ".join(f"WHEN {quoted(a)} THEN {quoted(b)}" for a, b in COUNTRY_ALIASES.items())

ORACLE: dict[str, str] = {
    "clean_text": f"SELECT doc_id, {clean('text')} AS clean_text FROM documents",
    "unwrap_records": f"""
      SELECT c_mktsegment, 0 AS pos, c_custkey::VARCHAR AS id, c_name AS company, n_name AS country
      FROM {CUSTOMERS}""",
    "records_per_response": """
      SELECT c_mktsegment AS kind, count(*) AS n_lines,
        (count(*) * CASE WHEN c_mktsegment = 'BUILDING' THEN 5 ELSE 1 END)::BIGINT AS n_items
      FROM customer GROUP BY c_mktsegment
      UNION ALL SELECT 'junk', 5 * count(*), 2 * count(*) FROM nation""",
    "flatten_customers": customers(),
    "default_description": f"SELECT doc_id, {DOC_DESCRIPTION} AS description FROM documents",
    "joined_types": f'SELECT doc_id, {DOC_CODES} AS "businessType_codes" FROM documents',
    "program_levels": """
      SELECT p_partkey,
        CASE WHEN p_type = 'ECONOMY' THEN '' ELSE p_name END AS "programLevel_logoUrl",
        CASE WHEN p_type = 'ECONOMY' THEN '' ELSE p_brand END AS "programLevel_globalId",
        CASE WHEN p_type = 'ECONOMY' THEN '' ELSE p_size::VARCHAR END AS "programLevel_displayRank",
        CASE WHEN p_type = 'ECONOMY' THEN '' ELSE (p_retailprice > 1000)::VARCHAR END
          AS "programLevel_b2cAvailable"
      FROM part""",
    "free_form_arrays": r"""
      SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
        '{"line": ' || l_linenumber || ', "flags": ["' || l_returnflag || '", "a, b: \"c\""]}; "'
          || l_linestatus || '"; ' || l_quantity || '; null; true' AS competence,
        '' AS "openingHours"
      FROM lineitem""",
    "malformed_records": """
      WITH p AS (SELECT p_partkey, p_size, p_retailprice <= 1000 AND p_size <> 0 AS bad_details,
          p_type IN ('ECONOMY', 'PROMO') AS bad_types,
          CASE WHEN p_type = 'ECONOMY' THEN '[' || p_size || ']' WHEN p_type = 'PROMO' THEN '"word"'
            ELSE '[{"code":"x"}]' END AS types,
          CASE WHEN p_retailprice > 1000 THEN '{}' ELSE p_size::VARCHAR END AS details
        FROM part)
      SELECT p_partkey, 0 AS pos,
        '{"id":' || p_partkey || ',"partnerDetails":' || details || ',"businessType":' || types || '}' AS record,
        concat_ws(',', CASE WHEN bad_details THEN 'partnerDetails' END,
          CASE WHEN bad_types THEN 'businessType' END) AS fields
      FROM p WHERE bad_details OR bad_types""",
    "drop_empty_columns": f"""
      SELECT {", ".join(f'{CUSTOMER_COLUMNS[c]} AS "{c}"' for c in FILLED_COLUMNS)},
        c_custkey::VARCHAR AS source_key
      FROM {CUSTOMERS}""",
    "dedupe_first": f"""
      SELECT doc_id, lang AS id, source AS city, {clean('text')} AS "companyName" FROM documents
      QUALIFY row_number() OVER (
        PARTITION BY lower(lang || '||' || {clean('text')} || '||' || source || '||') ORDER BY doc_id) = 1""",
    "ingest_documents": f"""
      SELECT doc_id AS line_id, 0 AS pos,
        {", ".join(f'{DOCUMENT_COLUMNS[c]} AS "{c}"' for c in OUTPUT_COLUMNS)}
      FROM documents
      QUALIFY row_number() OVER (PARTITION BY lower(doc_id || '||' || {clean('text')} || '||'
        || {clean('source')} || '||' || {clean('lang')}) ORDER BY doc_id) = 1""",
    "fill_rates": f"""
      WITH flat AS ({customers()}), filled AS ({FILL_RATES})
      SELECT col_pos, column_name, n_filled, 100.0::DOUBLE * n_filled / n AS pct,
        repeat('#', floor(100.0::DOUBLE * n_filled / n / 5)::INT) AS bar,
        100.0::DOUBLE * n_filled / n < 10 AS is_low
      FROM filled""",
    "quality_summary": f"""
      WITH flat AS ({customers()})
      SELECT count(*) AS n_rows, {len(OUTPUT_COLUMNS)} AS n_columns,
        count(*) FILTER (try_cast(latitude AS DOUBLE) IS NULL) AS bad_latitude,
        count(*) FILTER (try_cast(longitude AS DOUBLE) IS NULL) AS bad_longitude,
        count(*) - count(DISTINCT id) AS duplicate_ids
      FROM flat""",
    "coordinate_ranges": f"""
      WITH flat AS ({customers()})
      SELECT count(*) FILTER (abs(try_cast(latitude AS DOUBLE)) > 90) AS latitude_out_of_range,
        count(*) FILTER (abs(try_cast(longitude AS DOUBLE)) > 180) AS longitude_out_of_range
      FROM flat""",
    "duplicate_ids": """
      SELECT count(*) AS n_rows, 1 AS n_columns, count(*) - count(DISTINCT l_orderkey) AS duplicate_ids
      FROM lineitem""",
    "country_counts": """
      SELECT n_name AS country, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey
      GROUP BY n_name ORDER BY n DESC, country LIMIT 20""",
    "country_totals": """
      SELECT count(*) AS n_records, count(DISTINCT c_nationkey) AS n_countries FROM customer""",
    "type_counts": """
      SELECT word AS "businessType_names", count(*) AS n
      FROM (SELECT unnest(string_split(p_name, ' ')) AS word FROM part) GROUP BY word""",
    "type_counts_from_arrays": f"""
      SELECT line, count(*) AS n FROM (SELECT unnest({LINES}) AS line FROM documents)
      WHERE {strip('line')} <> '' GROUP BY line""",
    "sample_rows": customers(
        ["companyName", "city", "country", "contact_email", "contact_phone", "businessType_names"],
        "ORDER BY c_custkey LIMIT 3",
    ),
    "batch_plan": """
      SELECT o_orderkey AS id, pos, pos // 50 AS batch_idx, pos // 300 AS group_idx
      FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS pos FROM orders)""",
    "batch_id_lists": """
      SELECT pos // 300 AS group_idx, pos // 50 AS batch_idx,
        string_agg(o_orderkey::VARCHAR, ',' ORDER BY pos) AS ids
      FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS pos FROM orders)
      GROUP BY 1, 2""",
    "attempt_outcomes": f"""
      SELECT batch_idx, attempt, outcome, (outcome = 'success')::INT AS n_records,
        CASE WHEN attempt > 0 THEN 2.0::DOUBLE * pow(2, attempt - 1) ELSE 0.0::DOUBLE END AS wait_seconds,
        outcome IN ('success', 'empty') AS stops, preview
      FROM ({ATTEMPTS})""",
    "batch_status": f"""
      SELECT batch_idx, coalesce(stop_with, 'FAILED') AS final_status,
        coalesce(stop_at, last_at) + 1 AS attempts_made,
        (coalesce(stop_with, '') = 'success')::BIGINT AS n_records,
        2.0::DOUBLE * (pow(2, coalesce(stop_at, last_at)) - 1) AS wait_seconds
      FROM ({BATCHES})""",
    "lost_ids": f"""
      SELECT conv_id AS batch_idx, conv_id || '-' || turn AS id FROM conversations
      WHERE conv_id IN (SELECT batch_idx FROM ({BATCHES}) WHERE stop_with IS NULL)""",
    "failed_ids_file": f"""
      SELECT conv_id AS batch_idx, conv_id || '-' || turn AS id FROM conversations
      WHERE conv_id IN (SELECT batch_idx FROM ({BATCHES}) WHERE stop_with IS NULL)""",
    "coverage": """
      SELECT c_custkey AS id, count(o_custkey) AS n_returned
      FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey""",
    "coverage_gap": """
      SELECT c_custkey AS id FROM customer
      WHERE NOT EXISTS (SELECT 1 FROM events WHERE user_id = c_custkey)""",
    "lookup_details": """
      SELECT c_custkey AS id, o_orderkey, o_orderpriority
      FROM customer LEFT JOIN orders ON c_custkey = o_custkey""",
    "listing_locations": f"""
      SELECT s_suppkey, 0 AS pos, s_suppkey AS id, s_nationkey + 0.5::DOUBLE AS latitude,
        NULL::DOUBLE AS longitude, s_nationkey::VARCHAR AS "countryId" FROM ({SUPPLIER_LISTED})
      UNION ALL
      SELECT s_suppkey, 2, NULL, NULL, NULL, s_nationkey::VARCHAR FROM ({SUPPLIER_LISTED})""",
    "broken_listings": """
      SELECT s_suppkey, '{"partnerLocations":' || s_suppkey AS value FROM supplier WHERE s_acctbal < 0""",
    "listing_contract": f"""
      WITH n AS (SELECT count(*) AS n FROM ({SUPPLIER_LISTED}))
      SELECT 'key_id' AS rule, 2 * n AS measured, 3 * n AS "limit", n = 0 AS passed FROM n
      UNION ALL SELECT 'key_latitude', 2 * n, 3 * n, n = 0 FROM n
      UNION ALL SELECT 'n_entries', 3 * n, 3000, 3 * n > 3000 FROM n""",
    "combined_configs": """
      SELECT 'customers' AS config_id, c_custkey AS id, c_mktsegment AS segment, NULL AS name FROM customer
      UNION ALL SELECT 'suppliers', s_suppkey, NULL, s_name FROM supplier""",
    "link_extract": f"""
      SELECT page_id, unnest(range(len(m)))::INT AS pos, unnest(m) AS match
      FROM (SELECT page_id, {HREFS} AS m FROM pages)""",
    "link_counts": f"""
      SELECT page_id, len(m)::INT AS n_matches, {joined('m[1:10]')} AS sample
      FROM (SELECT page_id, {HREFS} AS m FROM pages)""",
    "distinct_paths": f"""
      SELECT DISTINCT match FROM (SELECT unnest({HREFS}) AS match FROM pages)
      WHERE length(match) < 150 AND ({" OR ".join(f"contains(match, {quoted(k)})" for k in PATH_KEYWORDS)})""",
    "paths_per_page": f"""
      SELECT page_id, {joined(f'list_sort(list_distinct({HREFS}))[1:20]')} AS matches FROM pages""",
    "embedded_json": """
      SELECT page_id, 0 AS pos, chr(10) || '{"page":' || page_id || ',"ids":[1,2]}' AS blob,
        page_id AS state_page, true AS is_json FROM pages
      UNION ALL SELECT page_id, 1, 'broken', NULL, false FROM pages""",
    "keyword_context": keyword_hits("pages", "page_id", "html", PAGE_KEYWORDS, 80, 200, 250, 5),
    "keyword_context_documents": keyword_hits(
        "documents", "doc_id", "text", TEXT_KEYWORDS, 100, 200, 200, None
    ),
    "known_id_search": """
      SELECT doc_id, known_id, (p - 1)::INT AS "at",
        substring(text, greatest(1, p - 50), p + 100 - greatest(1, p - 50)) AS snippet
      FROM (SELECT doc_id, text, s_suppkey::VARCHAR AS known_id,
              strpos(text, s_suppkey::VARCHAR) AS p
            FROM documents JOIN supplier ON contains(text, s_suppkey::VARCHAR))""",
    "numeric_leaf_texts": f"""
      WITH leaves AS (SELECT page_id, regexp_extract_all(html, {quoted(LEAF)}) AS ms FROM pages),
      texts AS (SELECT page_id, [{LEAF_TEXT} FOR m IN ms IF {OPEN_NAME} = {CLOSE_NAME}] AS ts FROM leaves),
      wanted AS (SELECT page_id,
        [t FOR t IN ts IF regexp_matches(t, '[0-9]{{3,4}}') AND length(t) < 50][1:20] AS w FROM texts)
      SELECT page_id, unnest(range(len(w)))::INT AS pos, unnest(w) AS leaf_text FROM wanted""",
    "url_parts": """
      SELECT page_id, split_part(url, '?', 2) AS query,
        string_split(url, '/')[-1] AS base_name,
        split_part(url, '&ref=', 1) AS stable_url,
        contains(url, 'blog') OR contains(url, 'utm_') OR contains(url, '/en/') AS is_wanted,
        contains(url, 'page=que') OR contains(lower(html), 'que') AS mentions_value
      FROM pages""",
    "elapsed_log": """
      SELECT event_id, epoch_us(ts) - (SELECT epoch_us(min(ts)) FROM events) AS elapsed_us FROM events""",
    "session_elapsed": """
      SELECT event_id, user_id,
        epoch_us(ts) - epoch_us(min(ts) OVER (PARTITION BY user_id)) AS elapsed_us FROM events""",
    "api_calls": f"""
      SELECT event_id, stable_url AS url, body FROM ({TRAFFIC})
      WHERE event_type = 'purchase'""",
    "calls_after_mark": f"""
      SELECT event_id, stable_url || '&ts=' || event_id AS url FROM ({TRAFFIC})
      WHERE ts >= TIMESTAMP '{MARK}'""",
    "request_ids": f"""
      SELECT event_id, CASE WHEN event_type = 'purchase' THEN 3 END AS n_ids,
        CASE WHEN event_type = 'purchase' THEN '1,2,' || user_id END AS first_ids,
        CASE WHEN event_type <> 'purchase' THEN body[1:150] END AS preview
      FROM ({TRAFFIC})""",
    "response_shapes": f"""
      SELECT event_id, status, {SHAPE} AS shape,
        CASE WHEN event_type = 'click' THEN 2 END AS n_items,
        CASE WHEN event_type = 'click' THEN 'object' END AS first_item,
        CASE event_type WHEN 'view' THEN 'k' WHEN 'error' THEN 'code,detail'
          WHEN 'purchase' THEN 'count,ids' END AS first_keys,
        CASE WHEN event_type = 'purchase' THEN user_id::VARCHAR END AS total,
        CASE WHEN event_type IN ('view', 'purchase') THEN body[1:80] END AS detail,
        CASE WHEN event_type = 'signup' THEN body[1:100] END AS preview,
        CASE WHEN event_type = 'click' THEN 'k' END AS item_keys
      FROM ({TRAFFIC})""",
    "shape_counts": f"""
      SELECT {SHAPE} AS shape, status, count(*) AS n FROM ({TRAFFIC}) GROUP BY ALL""",
    "id_marks": """
      SELECT event_id, event_type = 'purchase' AS has_marks FROM events""",
    "nested_id_paths": f"""
      SELECT vec_id, unnest(['$.store.deep.ids', '$.store.list.0.ids']) AS path, len(v)::INT AS n_items,
        {joined('v[1:5]')} AS sample
      FROM ({VECTORS}) WHERE len(v) > 10""",
    "id_list_keys": f"""
      SELECT vec_id, 'vals' AS key, len(v)::INT AS n_items, {joined('v[1:5]')} AS sample
      FROM ({VECTORS}) WHERE len(v) > 50""",
    "country_key_arrays": f"""
      SELECT vec_id, 'store.Countries' AS path, len(v)::INT AS n_items, {joined('v[1:5]')} AS sample
      FROM ({VECTORS}) WHERE len(v) > 10""",
    "distinct_last": """
      SELECT user_id, min(event_id) AS first_pos, arg_max(event_type, event_id) AS event_type,
        arg_max(props, event_id) AS props
      FROM events GROUP BY user_id ORDER BY first_pos LIMIT 15""",
    "ordered_distinct": f"""
      WITH l AS (SELECT doc_id, {LINES} AS l FROM documents),
      d AS (SELECT doc_id, [x FOR x, i IN l IF list_position(l, x) = i] AS d FROM l)
      SELECT doc_id, len(d)::INT AS n_lines, array_to_string(d, chr(10)) AS lines FROM d""",
    "snapshot_delta": """
      SELECT c_custkey AS id,
        CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'new' WHEN 'BUILDING' THEN 'removed'
          ELSE 'changed' END AS change,
        CASE c_mktsegment WHEN 'FURNITURE' THEN 'companyName' WHEN 'HOUSEHOLD' THEN 'city' END
          AS changed_columns
      FROM customer WHERE c_mktsegment <> 'MACHINERY'""",
    "country_aliases": f"""
      SELECT c_custkey, CASE n_name {ALIAS_CASE} ELSE n_name END AS country FROM {CUSTOMERS}""",
    "country_alias_table": f"""
      SELECT c_custkey, CASE WHEN r_name = 'ASIA' THEN n_name ELSE r_name END AS country
      FROM {CUSTOMERS}""",
    "zero_coordinates": """
      SELECT event_id,
        CASE WHEN event_type = 'click' OR (event_type = 'view' AND user_id = 0) THEN NULL
          ELSE user_id::VARCHAR END AS latitude,
        CASE WHEN event_type = 'click' OR (event_type = 'view' AND user_id = 0) THEN NULL
          WHEN event_type = 'view' THEN '0' ELSE 'n/a' END AS longitude
      FROM events""",
    "threshold_checks": f"""
      WITH f AS (SELECT 100.0::DOUBLE * count(*) FILTER ({POSITIVE}) / count(*) AS d FROM {CUSTOMERS})
      SELECT 'id_fill_pct' AS rule, 100.0::DOUBLE AS measured, 100.0::DOUBLE AS "limit", true AS passed
      UNION ALL SELECT 'companyName_fill_pct', 100.0, 99.0, true
      UNION ALL SELECT 'description_fill_pct', d, 95.0, d >= 95 FROM f
      UNION ALL SELECT 'duplicate_ids', 0.0, 0.0, true""",
    "without_pii": customers([c for c in OUTPUT_COLUMNS if c not in PII_COLUMNS]),
    "csv_round_trip": f"""
      SELECT doc_id::VARCHAR AS id, {clean('text')} AS "companyName", {DOC_CODES} AS "businessType_codes"
      FROM documents""",
    "raw_round_trip": customers(),
    "json_by_country": f"""
      SELECT c_custkey::VARCHAR AS id, c_name AS "companyName", n_name AS country, n_name AS results
      FROM {CUSTOMERS}""",
    "stream_records": f"""
      SELECT doc_id::VARCHAR AS id, {clean('text')} AS "companyName", {clean('source')} AS city,
        {clean('lang')} AS country FROM documents
      UNION ALL SELECT * FROM ({customers(['id', 'companyName', 'city', 'country'])})""",
    "stream_dedupe": "SELECT DISTINCT user_id, event_type FROM events",
}

_LEAVES = f"[{LEAF_TEXT} FOR m IN regexp_extract_all(html, {quoted(LEAF)}) IF {OPEN_NAME} = {CLOSE_NAME}]"
ORACLE["open_leaf_texts"] = f"""
      WITH texts AS (SELECT page_id, list_concat(
          [mark || (100 + page_id % 900)::VARCHAR || nth FOR mark, nth IN ['n ', 'm ', 'c ', 'e ', 't ', 'u ', 'o ']], {_LEAVES}) AS ts
        FROM pages),
      wanted AS (SELECT page_id,
        [t FOR t IN ts IF regexp_matches(t, '[0-9]{{3,4}}') AND length(t) < 50][1:20] AS w FROM texts)
      SELECT page_id, unnest(range(len(w)))::INT AS pos, unnest(w) AS leaf_text FROM wanted"""
ORACLE["stored_delta"] = ORACLE["snapshot_delta"]
ORACLE |= {
    name: sql.replace("<BATCHES>", BATCHES).replace("<TRAFFIC>", TRAFFIC) for name, sql in EDGE_ORACLE.items()
}
