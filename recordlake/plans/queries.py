"""Registered queries: every operator over whole test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordlake.functions import text as tx
from recordlake.functions import typed
from recordlake.operators import (
    audit,
    dedupe,
    delta,
    flatten,
    jsonpath,
    merkle,
    profile,
    textmine,
    traffic,
    unwrap,
)
from recordlake.plans import derive
from recordlake.plans.derive import table
from recordlake.plans.edge_queries import EDGE_QUERIES
from recordlake.plans.run import combine_configs, unique_records
from recordlake.schema import OUTPUT_COLUMNS
from recordlake.session import scratch_path
from recordlake.sources import raw as raw_source
from recordlake.sources import sinks
from recordlake.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]

# --- fixed values: search words and aliases used by the queries below ----------------
PAGE_KEYWORDS = ["track(0)", "article", "/to", "nav", "the", "ad 0", "que", "search"]
TEXT_KEYWORDS = ["the", "und", "que", "der", "@", "http"]
PATH_KEYWORDS = ["th", "an", "es"]
COUNTRY_ALIASES = {"NATION_0": "Zero Land", "NATION_1": "NATION_2", "NATION_24": "Last Land"}
HREF = 'href="(/[^"]*)"'
MARK = "2024-01-15 00:00:00"


def _joined(c: Column) -> Column:
    return F.array_join(c, ",")


def flat_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = derive.customer_lines(spark, sf_dir).select("value")
    both = lines.unionByName(derive.junk_lines(spark, sf_dir))
    return flatten.flatten_records(unwrap.explode_records(both))


# --- text and records ------------------------------------------------------------------


def clean_text(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", tx.clean(F.col("text")).alias("clean_text"))


def unwrap_records(spark, sf_dir):
    lines = derive.customer_lines(spark, sf_dir)
    records = unwrap.explode_records(lines, ["c_mktsegment"])
    return records.select(
        "c_mktsegment",
        "pos",
        tx.clean(F.col("rec.id")).alias("id"),
        tx.clean(F.col("rec.companyName")).alias("company"),
        tx.clean(F.col("rec.country")).alias("country"),
    )


def records_per_response(spark, sf_dir):
    lines = derive.customer_lines(spark, sf_dir).select(F.col("c_mktsegment").alias("kind"), "value")
    junk = derive.junk_lines(spark, sf_dir).select(F.lit("junk").alias("kind"), "value")
    counted = unwrap.records_per_line(lines.unionByName(junk), ["kind"])
    return counted.groupBy("kind").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("n_records").alias("n_items")
    )


def flatten_customers(spark, sf_dir):
    return flat_customers(spark, sf_dir)


def default_description(spark, sf_dir):
    records = unwrap.explode_records(derive.document_lines(spark, sf_dir), ["doc_id"])
    return flatten.flatten_records(records, ["doc_id"]).select("doc_id", "description")


def joined_types(spark, sf_dir):
    records = unwrap.explode_records(derive.document_lines(spark, sf_dir), ["doc_id"])
    flat = flatten.flatten_records(records, ["doc_id"])
    return flat.select("doc_id", "businessType_codes")


def program_levels(spark, sf_dir):
    records = unwrap.explode_records(derive.part_lines(spark, sf_dir), ["p_partkey"])
    flat = flatten.flatten_records(records, ["p_partkey"])
    return flat.select("p_partkey", *[c for c in OUTPUT_COLUMNS if c.startswith("programLevel_")])


def free_form_arrays(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem")
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    record = F.concat(
        F.lit('{"competence":[{"line":'), F.col("l_linenumber").cast("string"),
        F.lit(',"flags":["'), F.col("l_returnflag"), F.lit('","a, b: \\"c\\""]},"'),
        F.col("l_linestatus"), F.lit('",'), F.col("l_quantity").cast("string"),
        F.lit(',null,true],"openingHours":[]}'),
    )
    lines = items.select(*keys, derive.wrap(record).alias("value"))
    flat = flatten.flatten_records(unwrap.explode_records(lines, keys), keys)
    return flat.select(*keys, "competence", "openingHours")


def malformed_records(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    size = F.col("p_size").cast("string")
    types = (
        F.when(F.col("p_type") == "ECONOMY", F.concat(F.lit("["), size, F.lit("]")))
        .when(F.col("p_type") == "PROMO", F.lit('"word"'))
        .otherwise(F.lit('[{"code":"x"}]'))
    )
    record = F.concat(
        F.lit('{"id":'), F.col("p_partkey").cast("string"), F.lit(',"partnerDetails":'),
        F.when(F.col("p_retailprice") > 1000, F.lit("{}")).otherwise(size),
        F.lit(',"businessType":'), types, F.lit("}"),
    )
    lines = part.select("p_partkey", derive.wrap(record).alias("value"))
    found = unwrap.malformed_records(lines, ["p_partkey"])
    return found.select("p_partkey", "pos", "record", _joined(F.col("fields")).alias("fields"))


def drop_empty_columns(spark, sf_dir):
    facts = derive.customer_facts(spark, sf_dir)
    lines = facts.select("c_custkey", derive.wrap(derive.customer_record()).alias("value"))
    records = unwrap.explode_records(lines, ["c_custkey"])
    flat = flatten.flatten_records(records, ["c_custkey"])
    extra = flat.withColumn("source_key", F.col("c_custkey").cast("string"))
    extra = extra.withColumn("never_filled", F.lit("")).drop("c_custkey")
    return flatten.drop_empty_columns(flatten.order_columns(extra))


def dedupe_first(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.col("lang").alias("id"),
        tx.clean(F.col("text")).alias("companyName"),
        F.col("source").alias("city"),
        F.lit("").alias("country"),
    )
    return dedupe.first_wins(docs, ["doc_id"]).select("doc_id", "id", "city", "companyName")


def ingest_documents(spark, sf_dir):
    docs = derive.document_lines(spark, sf_dir)
    unique = unique_records(docs.withColumnRenamed("doc_id", "line_id"), ["line_id", "pos"])
    return unique.select("line_id", "pos", *OUTPUT_COLUMNS)


# --- quality reports -----------------------------------------------------------------------


def fill_rates(spark, sf_dir):
    return profile.fill_rates(flat_customers(spark, sf_dir))


def quality_summary(spark, sf_dir):
    return profile.quality_summary(flat_customers(spark, sf_dir))


def coordinate_ranges(spark, sf_dir):
    return profile.out_of_range_coordinates(flat_customers(spark, sf_dir))


def duplicate_ids(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem")
    ids = items.select(F.col("l_orderkey").cast("string").alias("id"))
    return profile.quality_summary(ids)


def country_counts(spark, sf_dir):
    return profile.value_counts(flat_customers(spark, sf_dir), "country")


def country_totals(spark, sf_dir):
    counted = profile.value_counts(flat_customers(spark, sf_dir), "country", n=None)
    return counted.agg(
        F.sum("n").alias("n_records"), F.count(F.lit(1)).alias("n_countries")
    )


def type_counts(spark, sf_dir):
    records = unwrap.explode_records(derive.part_lines(spark, sf_dir))
    flat = flatten.flatten_records(records)
    return profile.exploded_counts(flat, "businessType_names")


def type_counts_from_arrays(spark, sf_dir):
    lines = table(spark, sf_dir, "documents").select(F.split("text", "\n").alias("line"))
    return profile.array_counts(lines, "line")


def sample_rows(spark, sf_dir):
    lines = derive.customer_lines(spark, sf_dir)
    flat = flatten.flatten_records(unwrap.explode_records(lines, ["c_custkey"]), ["c_custkey", "pos"])
    return profile.sample_rows(flat, ["c_custkey", "pos"])


# --- batches, attempts, coverage ----------------------------------------------------------


def batch_plan(spark, sf_dir):
    ids = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    return audit.plan_batches(ids, ["id"])


def batch_id_lists(spark, sf_dir):
    ids = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    lists = audit.batch_lists(audit.plan_batches(ids, ["id"]), "id")
    return lists.select("group_idx", "batch_idx", _joined(F.col("ids").cast("array<string>")).alias("ids"))


def attempt_outcomes(spark, sf_dir):
    return audit.attempt_outcomes(derive.attempts(spark, sf_dir)).select(
        "batch_idx", "attempt", "outcome", "n_records", "wait_seconds", "stops", "preview"
    )


def batch_status(spark, sf_dir):
    return audit.batch_status(audit.attempt_outcomes(derive.attempts(spark, sf_dir)))


def lost_ids(spark, sf_dir):
    plan = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("batch_idx"), F.concat_ws("-", "conv_id", "turn").alias("id")
    )
    status = audit.batch_status(audit.attempt_outcomes(derive.attempts(spark, sf_dir)))
    return audit.lost_ids(plan, status)


def failed_ids_file(spark, sf_dir):
    path = scratch_path(spark, "failed-ids")
    sinks.write_failed_ids(lost_ids(spark, sf_dir), path)
    return spark.read.schema("batch_idx bigint, id string").json(path)


def _customer_ids(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))


def _order_records(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("id"), "o_orderkey", "o_orderpriority"
    )


def coverage(spark, sf_dir):
    return audit.coverage(_customer_ids(spark, sf_dir), _order_records(spark, sf_dir))


def coverage_gap(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(F.col("user_id").alias("id"))
    return audit.coverage_gap(_customer_ids(spark, sf_dir), events)


def lookup_details(spark, sf_dir):
    return audit.lookup_details(_customer_ids(spark, sf_dir), _order_records(spark, sf_dir))


# --- listings and configurations --------------------------------------------------------


def _listings(spark, sf_dir):
    supplier = table(spark, sf_dir, "supplier")
    key = F.col("s_suppkey").cast("string")
    nation = F.col("s_nationkey").cast("string")
    doc = F.when(
        F.col("s_acctbal") < 0, F.concat(F.lit('{"partnerLocations":'), key)
    ).otherwise(
        F.concat(
            F.lit('{"partnerLocations":[{"id":'), key, F.lit(',"latitude":'), nation,
            F.lit('.5,"countryId":"'), nation, F.lit('"},{"latitude":1.5},{"id":null,"countryId":"'),
            nation, F.lit('"}]}'),
        )
    )
    return supplier.select("s_suppkey", doc.alias("value"))


def listing_locations(spark, sf_dir):
    found = raw_source.explode_locations(_listings(spark, sf_dir), keep=["s_suppkey"])
    return found.select("s_suppkey", "pos", "id", "latitude", "longitude", "countryId")


def broken_listings(spark, sf_dir):
    return raw_source.broken_listings(_listings(spark, sf_dir)).select("s_suppkey", "value")


def listing_contract(spark, sf_dir):
    listings = _listings(spark, sf_dir).select(
        F.explode(raw_source.listing_entries(F.col("value"))).alias("entry")
    )
    return delta.contract_checks(listings, ["id", "latitude"], 3000)


def combined_configs(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    supplier = table(spark, sf_dir, "supplier")
    both = combine_configs(
        {
            "customers": customer.select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment")),
            "suppliers": supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")),
        }
    )
    return both.select("config_id", "id", "segment", "name")


# --- pages and text -----------------------------------------------------------------------


def link_extract(spark, sf_dir):
    return textmine.extract_all(table(spark, sf_dir, "pages"), "html", HREF, 1, ["page_id"])


def link_counts(spark, sf_dir):
    found = textmine.match_counts(table(spark, sf_dir, "pages"), "html", HREF, 1, ["page_id"])
    return found.withColumn("sample", _joined(F.col("sample")))


def distinct_paths(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return textmine.distinct_matches(pages, "html", HREF, 1, max_length=150, keywords=PATH_KEYWORDS)


def paths_per_page(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    found = textmine.distinct_matches_per_text(pages, "html", HREF, 1, ["page_id"])
    return found.withColumn("matches", _joined(F.col("matches")))


def embedded_json(spark, sf_dir):
    state = F.concat(
        F.lit("<script type='application/json' id=\"s\">\n{\"page\":"), F.col("page_id").cast("string"),
        F.lit(',"ids":[1,2]}</script><script type="application/json">broken</script>'),
    )
    pages = table(spark, sf_dir, "pages").select("page_id", F.concat("html", state).alias("html"))
    blocks = textmine.embedded_json(pages, "html", ["page_id"])
    return blocks.select(
        "page_id", "pos", "blob",
        typed.text_of(typed.fields(F.col("parsed"))["page"]).try_cast("bigint").alias("state_page"),
        F.col("parsed").isNotNull().alias("is_json"),
    )


def keyword_context(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return textmine.keyword_hits(pages, "html", PAGE_KEYWORDS, ["page_id"])


def keyword_context_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return textmine.keyword_hits(
        docs, "text", TEXT_KEYWORDS, ["doc_id"], before=100, after=200, cap=200, max_hits=None
    )


def known_id_search(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ids = table(spark, sf_dir, "supplier")
    return textmine.known_id_hits(docs, ids, "doc_id", "text", "s_suppkey")


def numeric_leaf_texts(spark, sf_dir):
    return textmine.numeric_leaf_texts(table(spark, sf_dir, "pages"), "html", ["page_id"])


def url_parts(spark, sf_dir):
    url = F.col("url")
    return table(spark, sf_dir, "pages").select(
        "page_id",
        tx.url_query(url).alias("query"),
        tx.url_base_name(url).alias("base_name"),
        tx.drop_volatile(url, "&ref=").alias("stable_url"),
        tx.contains_any(url, ["blog", "utm_", "/en/"]).alias("is_wanted"),
        traffic.mentions_value(url, F.col("html"), "page", "que").alias("mentions_value"),
    )


# --- traffic logs and unknown JSON ----------------------------------------------------------


def elapsed_log(spark, sf_dir):
    return traffic.with_elapsed(derive.traffic(spark, sf_dir)).select("event_id", "elapsed_us")


def session_elapsed(spark, sf_dir):
    timed = traffic.with_session_elapsed(derive.traffic(spark, sf_dir), "user_id")
    return timed.select("event_id", "user_id", "elapsed_us")


def api_calls(spark, sf_dir):
    log = derive.traffic(spark, sf_dir)
    kept = traffic.api_responses(log, status=200, method="POST", keywords=["purchase", "view"])
    return kept.select("event_id", tx.drop_volatile(F.col("url")).alias("url"), "body")


def calls_after_mark(spark, sf_dir):
    log = derive.traffic(spark, sf_dir)
    return traffic.after_mark(log, F.lit(MARK).cast("timestamp_ntz"), "ts").select("event_id", "url")


def request_ids(spark, sf_dir):
    found = traffic.request_ids(derive.traffic(spark, sf_dir), keep=["event_id"])
    return found.withColumn("first_ids", _joined(F.col("first_ids")))


def response_shapes(spark, sf_dir):
    shapes = jsonpath.response_shapes(derive.traffic(spark, sf_dir), keep=["event_id", "status"])
    return shapes.drop("first_items").withColumns({c: _joined(F.col(c)) for c in ("first_keys", "item_keys")})


def shape_counts(spark, sf_dir):
    shapes = jsonpath.response_shapes(derive.traffic(spark, sf_dir), keep=["status"])
    return jsonpath.shape_counts(shapes)


def id_marks(spark, sf_dir):
    log = derive.traffic(spark, sf_dir)
    return log.select("event_id", jsonpath.has_any_key(F.col("body")).alias("has_marks"))


def nested_id_paths(spark, sf_dir):
    docs = derive.vector_documents(spark, sf_dir)
    found = jsonpath.named_arrays(docs, "body", keep=["vec_id"])
    return found.withColumn("sample", _joined(F.col("sample")))


def id_list_keys(spark, sf_dir):
    found = jsonpath.id_list_keys(derive.vector_documents(spark, sf_dir), "body", keep=["vec_id"])
    return found.withColumn("sample", _joined(F.col("sample")))


def country_key_arrays(spark, sf_dir):
    found = jsonpath.key_arrays(derive.vector_documents(spark, sf_dir), "body", keep=["vec_id"])
    return found.withColumn("sample", _joined(F.col("sample")))


def distinct_last(spark, sf_dir):
    log = table(spark, sf_dir, "events")
    return dedupe.first_position_last_value(log, "user_id", "event_id", ["event_type", "props"], 15)


def ordered_distinct(spark, sf_dir):
    lines = F.array_distinct(F.split("text", "\n"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.size(lines).alias("n_lines"), F.array_join(lines, "\n").alias("lines")
    )


# --- runs compared, values normalised, rules checked ----------------------------------------


def _two_runs(spark, sf_dir):
    facts = derive.customer_facts(spark, sf_dir)
    base = facts.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("companyName"),
        F.col("n_name").alias("city"), F.col("c_mktsegment").alias("segment"),
    )
    renamed = F.when(F.col("segment") == "FURNITURE", F.upper("companyName")).otherwise(F.col("companyName"))
    moved = F.when(F.col("segment") == "HOUSEHOLD", F.lit(None)).otherwise(F.col("city"))
    previous = base.where(F.col("segment") != "AUTOMOBILE")
    current = base.where(F.col("segment") != "BUILDING").withColumns(
        {"companyName": renamed, "city": moved}
    )
    return previous, current, ["companyName", "city", "segment"]


def snapshot_delta(spark, sf_dir):
    previous, current, columns = _two_runs(spark, sf_dir)
    found = delta.snapshot_delta(previous, current, columns, columns)
    return found.withColumn("changed_columns", _joined(F.col("changed_columns")))


def stored_delta(spark, sf_dir):
    """The same delta of two stored runs, from the digests of their ranges."""
    *runs, columns = _two_runs(spark, sf_dir)
    paths = [scratch_path(spark, name) for name in ("previous-run", "current-run")]
    for rows, path in zip(runs, paths):
        merkle.store_run(rows, path, columns, columns)
    found = merkle.stored_delta(spark, *paths, columns)
    return found.withColumn("changed_columns", _joined(F.col("changed_columns")))


def country_aliases(spark, sf_dir):
    facts = derive.customer_facts(spark, sf_dir)
    named = facts.select("c_custkey", F.concat(F.lit(" "), F.col("n_name"), F.lit(" ")).alias("country"))
    return delta.apply_aliases(named, "country", COUNTRY_ALIASES)


def country_alias_table(spark, sf_dir):
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    aliases = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_name").alias("alias"), F.col("r_name").alias("name")
    )
    facts = derive.customer_facts(spark, sf_dir)
    return delta.join_aliases(
        facts.select("c_custkey", F.col("n_name").alias("country")),
        "country",
        aliases.where(F.col("name") != "ASIA"),
    )


def zero_coordinates(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    placed = events.select(
        "event_id",
        F.when(F.col("event_type") == "click", "0.0").otherwise(F.col("user_id").cast("string")).alias("latitude"),
        F.when(F.col("event_type").isin("click", "view"), "0").otherwise("n/a").alias("longitude"),
    )
    return delta.null_island_to_null(placed)


def threshold_checks(spark, sf_dir):
    flat = flat_customers(spark, sf_dir)
    return delta.threshold_checks(flat, {"id": 100, "companyName": 99, "description": 95})


def without_pii(spark, sf_dir):
    return delta.drop_pii(flat_customers(spark, sf_dir))


# --- files and streams ----------------------------------------------------------------------


def csv_round_trip(spark, sf_dir):
    records = unwrap.explode_records(derive.document_lines(spark, sf_dir))
    flat = flatten.flatten_records(records).select("id", "companyName", "businessType_codes")
    path = scratch_path(spark, "csv")
    sinks.write_csv(flat, path)
    return raw_source.read_csv(spark, path, flat.columns)


def raw_round_trip(spark, sf_dir):
    path = scratch_path(spark, "raw")
    sinks.write_raw(derive.customer_lines(spark, sf_dir), path)
    unique = unique_records(raw_source.read_raw(spark, path))
    return unique.select(*OUTPUT_COLUMNS)


def json_by_country(spark, sf_dir):
    path = scratch_path(spark, "by-country")
    flat = flat_customers(spark, sf_dir).select("id", "companyName", "country")
    sinks.write_by_country(flat, path)
    ddl = "id string, companyName string, country string, results string"
    return spark.read.schema(ddl).json(path)


def stream_records(spark, sf_dir):
    raw_path, out, state = (scratch_path(spark, n) for n in ("lines", "stream", "state"))
    lines = derive.document_lines(spark, sf_dir).drop("doc_id")
    both = lines.unionByName(derive.customer_lines(spark, sf_dir).select("value"))
    sinks.write_raw(both, raw_path, compression="gzip")
    for query in ingest.run_stream(spark, raw_path, out, state):
        query.awaitTermination()
    return ingest.landed_records(spark, out, ["id", "companyName", "city", "country"])


def stream_dedupe(spark, sf_dir):
    out, state = scratch_path(spark, "seen"), scratch_path(spark, "seen-state")
    schema = table(spark, sf_dir, "events").schema
    # A pattern, because the table may be one file or a folder of files.
    events = spark.readStream.schema(schema).parquet(f"{sf_dir}/event?.parquet")
    rows = events.select("event_id", "user_id", "event_type")
    key = F.concat_ws("||", "user_id", "event_type")
    unique = ingest.drop_seen(rows, key, F.col("event_id")).select("user_id", "event_type")
    ingest.drain(unique, out, state).awaitTermination()
    return spark.read.parquet(out)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        clean_text, unwrap_records, records_per_response, flatten_customers, default_description,
        joined_types, program_levels, free_form_arrays, malformed_records, drop_empty_columns,
        dedupe_first, ingest_documents, fill_rates, quality_summary, coordinate_ranges, duplicate_ids,
        country_counts, country_totals, type_counts, type_counts_from_arrays, sample_rows,
        batch_plan, batch_id_lists, attempt_outcomes, batch_status, lost_ids, failed_ids_file, coverage,
        coverage_gap, lookup_details, listing_locations, broken_listings, listing_contract,
        combined_configs, link_extract, link_counts, distinct_paths, paths_per_page,
        embedded_json, keyword_context, keyword_context_documents, known_id_search,
        numeric_leaf_texts, url_parts, elapsed_log, session_elapsed, api_calls,
        calls_after_mark, request_ids, response_shapes, shape_counts, id_marks,
        nested_id_paths, id_list_keys, country_key_arrays, distinct_last, ordered_distinct,
        snapshot_delta, stored_delta, country_aliases, country_alias_table, zero_coordinates,
        threshold_checks, without_pii, csv_round_trip, raw_round_trip, json_by_country,
        stream_records, stream_dedupe,
    )
} | EDGE_QUERIES
