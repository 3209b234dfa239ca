"""Registered queries over inputs that the plain tables do not hold.

Repeated keys, lenient JSON, numbers of every form, null and blank keys, late attempts,
copies that differ, and whole runs with rejects and audit. Inputs are derived from whole
tables, row by row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from recordlake.operators import audit, delta, flatten, frequent, lattice, runstate, textmine, traffic, unwrap
from recordlake.plans import derive
from recordlake.plans.derive import table
from recordlake.plans.run import RunResult, arrivals, finish, first_arrivals, run_batch
from recordlake.schema import OUTPUT_COLUMNS
from recordlake.session import scratch_path
from recordlake.sources import numbered
from recordlake.sources import raw as raw_source
from recordlake.sources import sinks
from recordlake.sources.csv_split import read_csv_split
from recordlake.streaming import first, ingest
from recordlake.streaming.progress import UniqueProgress


def text(column: str):
    return F.col(column).cast("string")


def fill(template: str, **values) -> Column:
    """A text with ``<name>`` replaced by columns."""
    out = F.lit(template)
    for name, value in values.items():
        out = F.replace(out, F.lit(f"<{name}>"), value)
    return out


# --- JSON as strict as it is, whatever stands next to it -----------------------------------


def repeated_keys(spark, sf_dir):
    """The last of repeated keys counts, on every level; neighbours do not matter."""
    line = fill(
        '{"body":7,"body":["{x",{"id":0,"id":<key>,"city":"A","city":"<name>","competence":'
        '[{"a":1,"a":<size>},"{\\"a\\":1,\\"a\\":2}"],"businessType":[{"code":"x","code":"<name>"}]},5]}',
        key=text("p_partkey"), name=F.col("p_name"), size=text("p_size"),
    )
    lines = table(spark, sf_dir, "part").select(line.alias("value"))
    flat = flatten.flatten_records(unwrap.explode_records(lines), ["pos"])
    return flat.select("pos", "id", "city", "competence", "businessType_codes")


def scalar_texts(spark, sf_dir):
    """Numbers as plain text of their value; strings as they are."""
    record = fill(
        '{"id":<key>,"latitude":<key>e-7,"longitude":NaN,"productCount":<key>.0,"idGroup":<key>E12,'
        '"stateId":"1.0E10","zipCode":"<key>e-7","eshop":"true","emailExists":true,"address1":-0.00010,'
        '"address2":1<key>5000000.5,"city":-Infinity,"competence":[<key>e-7,1.50,"1.50",[<key>E12]]}',
        key=text("l_orderkey"),
    )
    keys = ["l_orderkey", "l_linenumber"]
    lines = table(spark, sf_dir, "lineitem").select(*keys, derive.wrap(record).alias("value"))
    flat = flatten.flatten_records(unwrap.explode_records(lines, keys), keys)
    return flat.select(
        *keys, "id", "latitude", "longitude", "productCount", "idGroup", "stateId", "zipCode", "eshop",
        "emailExists", "address1", "address2", "city", "competence",
    )


LENIENT = {
    "view": "{'id':1}", "click": '[{"id":1}]x', "error": '{"body":[{"id":1,}]}',
    "purchase": '[{"id":NaN},{"id":2}]', "signup": '"a\tb"',
}


def _lenient(spark, sf_dir):
    body = F.lit(None).cast("string")
    for kind, value in LENIENT.items():
        body = F.when(F.col("event_type") == kind, value).otherwise(body)
    return table(spark, sf_dir, "events").select("event_id", "event_type", body.alias("body"))


def lenient_attempts(spark, sf_dir):
    """Single quotes, trailing text, trailing commas and raw tabs are parse errors."""
    rows = _lenient(spark, sf_dir).select(
        F.col("event_id").alias("batch_idx"), F.lit(0).alias("attempt"), F.lit(200).alias("status"),
        F.lit(None).cast("string").alias("error"), "body",
    )
    return audit.attempt_outcomes(rows).select("batch_idx", "outcome", "n_records", "preview")


def rejected_lines(spark, sf_dir):
    """Lines that are no JSON, as a table; the same rule for envelopes and bare lines."""
    rows = _lenient(spark, sf_dir)
    line = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit('{"body":'), "body", F.lit("}"))).otherwise(F.col("body"))
    return unwrap.rejected_lines(rows.select("event_id", line.alias("value")), ["event_id"])


# --- null, blank and late keys ----------------------------------------------------------------


def session_elapsed_nulls(spark, sf_dir):
    session = F.when(F.col("user_id") % 7 != 0, F.col("user_id"))
    log = derive.traffic(spark, sf_dir).withColumn("session", session)
    return traffic.with_session_elapsed(log, "session").select("event_id", "session", "elapsed_us")


def late_attempts(spark, sf_dir):
    """Batches of which only attempts beyond the limit are known have failed."""
    late = F.when(F.col("batch_idx") % 2 == 0, F.col("attempt") + 4).otherwise(F.col("attempt"))
    return audit.batch_status(audit.attempt_outcomes(derive.attempts(spark, sf_dir)).withColumn("attempt", late))


def delta_null_ids(spark, sf_dir):
    base = table(spark, sf_dir, "customer").select(
        F.when(F.col("c_custkey") != 1, F.col("c_custkey")).alias("id"), F.col("c_name").alias("companyName"),
        F.col("c_mktsegment").alias("segment"),
    )
    current = base.withColumn("companyName", F.when(F.col("segment") == "BUILDING", "x").otherwise(F.col("companyName")))
    found = delta.snapshot_delta(base, current, ["companyName", "segment"], ["companyName", "segment"])
    return found.withColumn("changed_columns", F.array_join("changed_columns", ","))


def _some_countries(spark, sf_dir):
    segment = F.col("c_mktsegment")
    country = F.when(segment == "BUILDING", "").when(segment != "FURNITURE", F.col("n_name"))
    return derive.customer_facts(spark, sf_dir).select(text("c_custkey").alias("id"), country.alias("country"))


def json_blank_country(spark, sf_dir):
    path = scratch_path(spark, "blank-country")
    sinks.write_by_country(_some_countries(spark, sf_dir), path)
    return spark.read.schema("id string, country string, results string").json(path)


def alias_beside_name(spark, sf_dir):
    aliases = table(spark, sf_dir, "nation").select(F.col("n_name").alias("alias"), F.lower("n_name").alias("name"))
    rows = derive.customer_facts(spark, sf_dir).select(F.col("c_name").alias("name"), F.col("n_name").alias("country"))
    return delta.join_aliases(rows, "country", aliases)


# --- ids of any kind in texts ------------------------------------------------------------------


def _mixed_ids(spark, sf_dir):
    key = text("s_suppkey")
    kinds = F.array(F.concat(F.lit("AB-"), key), F.lpad(key, 24, "7"), F.concat(F.lit("-"), key), F.concat(F.lit(" é"), key))
    return table(spark, sf_dir, "supplier").select(F.explode(kinds).alias("id"))


def _marked_texts(spark, sf_dir, name, key, body):
    marks = fill("<t> ref AB-<k> <w> é<k>", t=body, k=(F.col(key) % 500).cast("string"), w=F.lpad(text(key), 24, "7"))
    return table(spark, sf_dir, name).select((F.col(key) % 3).alias("group"), marks.alias("text"))


def known_ids_any_kind(spark, sf_dir):
    """Alphanumeric, signed and long ids; texts that share a key."""
    texts = _marked_texts(spark, sf_dir, "documents", "doc_id", F.col("text"))
    return textmine.known_id_hits(texts, _mixed_ids(spark, sf_dir), "group", "text", "id")


def known_ids_joined(spark, sf_dir):
    """The same search with more ids than one automaton takes."""
    texts = _marked_texts(spark, sf_dir, "customer", "c_custkey", F.col("c_name"))
    return textmine.known_id_hits(texts, _mixed_ids(spark, sf_dir), "group", "text", "id", automaton_bytes=4000)


# --- counts over runs ------------------------------------------------------------------------------


def ids_over_runs(spark, sf_dir):
    """Distinct and duplicate ids of three runs, from what each of them stored of itself."""
    path = scratch_path(spark, "run-states")
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.when(F.col("c_custkey") % 5 > 0, F.col("c_name")).otherwise(" ").alias("companyName")
    )
    for k in (2, 3, 2):  # the second run of the same stamp takes the place of the first
        state = runstate.run_state(customer.where(F.col("id") % k == 0), f"run{k}", ["companyName"])
        state.write.mode("overwrite").parquet(f"{path}/{k}")
    runstate.run_state(customer, "all", ["companyName"]).write.parquet(f"{path}/all")
    states = spark.read.parquet(f"{path}/*")
    filled = runstate.fill_over_runs(states).first()
    return runstate.over_runs(states).withColumn("n_filled", F.lit(filled["filled"]).cast("long"))


# --- the schema of all responses ------------------------------------------------------------------


def _orders_as_responses(spark, sf_dir):
    """Orders as responses whose fields come and go with the key."""
    kind = F.col("o_orderkey") % 3
    line = F.concat(
        F.lit('{"id":'), text("o_orderkey"), F.lit(',"status":'), F.when(kind == 0, F.lit("null")).otherwise(F.lit('"x"')),
        F.when(kind == 1, F.lit(',"tags":[{"a":1,"b c":2.5},"t",{"a":null}]')).otherwise(F.lit(',"tags":[]')),
        F.when(kind == 2, F.lit(',"note":"n","note":{"deep":[[true]]}')).otherwise(F.lit("")), F.lit("}"),
    )
    return table(spark, sf_dir, "orders").select(kind.alias("kind"), line.alias("body"))


def merged_schema(spark, sf_dir):
    """Kinds, null and optional fields over all responses, from the states of three parts."""
    lines = _orders_as_responses(spark, sf_dir)
    states = [lattice.shape_state(lines.where(F.col("kind") == k)) for k in (0, 1, 2)]
    return lattice.merged_schema(lattice.merge_states(*states))


# --- frequent values ---------------------------------------------------------------------------


def frequent_words(spark, sf_dir):
    """The 20 most frequent words of all documents, without a shuffle of all words."""
    words = table(spark, sf_dir, "documents").select(F.explode(F.split("text", " ")).alias("word")).where("word <> ''")
    return frequent.top_values(words, "word")


def frequent_keys(spark, sf_dir):
    """Keys that are all about equally frequent: nothing is proven, all are counted."""
    return frequent.top_values(table(spark, sf_dir, "lineitem").select(text("l_orderkey").alias("key")), "key", 20, size=20)


# --- pages as browsers get them -------------------------------------------------------------------


OPEN_ELEMENTS = (
    "<div><ul><li>n <k>1<li>none<LI class='a>b'><b>m <k>2</b></ul><table><tr><td>c <k>3<td>d<tr><th>e <k>4</table>"
    "<dl><dt>t <k>5<dd>u <k>6</dl><p>o <k>7<p>q<br><k>8</div>"
)


def open_leaf_texts(spark, sf_dir):
    """Pages that begin with list items, cells, terms and paragraphs left open."""
    page = fill(OPEN_ELEMENTS + "<html>", k=(100 + F.col("page_id") % 900).cast("string"), html=F.col("html"))
    pages = table(spark, sf_dir, "pages").select("page_id", page.alias("html"))
    return textmine.numeric_leaf_texts(pages, "html", ["page_id"])


# --- copies, whole runs, streams ------------------------------------------------------------------


def _copied_lines(spark, sf_dir, copy: int):
    """Customers as records; later copies differ in letter case and in other columns."""
    record = fill(
        '{"id":<key>,"companyName":"<name>","city":"<seg>","country":"X","about":"","webSite":"<n>",'
        '"partnerDetails":{"about":"copy <n>"}}',
        key=(F.col("c_custkey") % 400).cast("string"),
        name=F.lit("Firm") if copy == 0 else F.lit("FIRM"),
        seg=F.col("c_mktsegment") if copy == 0 else F.lower("c_mktsegment"), n=F.lit(str(copy)),
    )
    return table(spark, sf_dir, "customer").select(derive.wrap(record).alias("value"))


def _write_copies(spark, sf_dir) -> str:
    path = scratch_path(spark, "copies")
    for copy in (0, 1):
        lines = _copied_lines(spark, sf_dir, copy).unionByName(derive.junk_lines(spark, sf_dir))
        sinks.write_raw(lines, f"{path}/copy={copy}")
    return path


def _run(spark, sf_dir, **options) -> tuple[RunResult, str]:
    out = scratch_path(spark, "run")
    return run_batch(spark, _write_copies(spark, sf_dir), out, "20240101_000000", **options), out


def run_records(spark, sf_dir):
    """Unique records of a run over copies: the first arrival of each."""
    return _run(spark, sf_dir, backup=False, drop_empty=False)[0].table


def run_counts(spark, sf_dir):
    """What a run reports: parsed, unique, rejected, missing and lost, and rows exported."""
    attempts, listing = scratch_path(spark, "attempts"), scratch_path(spark, "listing")
    derive.attempts(spark, sf_dir).write.json(attempts)
    entry = fill('{"id":<key>}', key=text("c_custkey"))
    table(spark, sf_dir, "customer").select(
        F.concat(F.lit('{"partnerLocations":['), entry, F.lit("]}")).alias("value")
    ).write.text(listing)
    locations = raw_source.explode_locations(spark.read.text(listing))
    log = raw_source.read_attempts(spark, attempts)
    out = scratch_path(spark, "run")
    raw = raw_source.read_raw(spark, _write_copies(spark, sf_dir))
    result = finish(spark, first_arrivals(arrivals(raw)), out, "s", locations=locations, attempts=log)
    rows = raw_source.read_csv(spark, f"{sinks.run_path(out, 'export_csv', 's')}/rows", result.table.columns)
    counts = {
        "parsed": result.parsed, "unique": result.unique, "rejected": result.rejected,
        "missing": result.reports["missing"].count(),
        "failed_batches": result.reports["batch_status"].where("final_status = 'FAILED'").count(),
        "exported": rows.count() + 1,  # the reader takes the first row for a header
    }
    return spark.createDataFrame([(k, int(v)) for k, v in counts.items()], "name string, n long")


def run_rejects(spark, sf_dir):
    return _run(spark, sf_dir, backup=False)[0].rejects.select("line")


def empty_run(spark, sf_dir):
    """A run without records: counts, and neither export nor reports."""
    path, out = scratch_path(spark, "junk"), scratch_path(spark, "run")
    sinks.write_raw(derive.junk_lines(spark, sf_dir), path)
    result = run_batch(spark, path, out, "s", backup=False)
    row = (result.parsed, result.unique, result.rejected, len(result.reports))
    return spark.createDataFrame([row], "parsed long, unique long, rejected long, reports long")


def stream_equals_batch(spark, sf_dir):
    """Copies over several batches of a stream: the first arrival survives, all 39 columns."""
    path, out, state = _write_copies(spark, sf_dir), scratch_path(spark, "stream"), scratch_path(spark, "state")
    for query in ingest.run_stream(spark, f"{path}/*", out, state, max_files=3):
        query.awaitTermination()
    return ingest.finish_stream(spark, out, "s", drop_empty=False).table.select(*OUTPUT_COLUMNS)


def _land_events(spark, sf_dir) -> str:
    """Events in three batches whose copies come out of order."""
    path, out, state = (scratch_path(spark, n) for n in ("events", "first", "first-state"))
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    for part in (2, 1, 0):
        events.where(F.pmod("event_id", F.lit(3)) == part).write.mode("append").parquet(path)
    # Each part has a file per split of the table that has rows.
    files = -(-len(spark.read.schema(events.schema).parquet(path).inputFiles()) // 3)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", max(files, 1)).parquet(path)
    key = F.concat_ws("||", "user_id", "event_type")
    first.land_first_arrivals(stream, key, ["event_id"], out, state).awaitTermination()
    return out


def stream_first_arrivals(spark, sf_dir):
    """The earliest event of each key stays."""
    landed = spark.read.parquet(_land_events(spark, sf_dir)).drop("batch")
    return first.last_revisions(landed, ["event_id"])


def stream_progress(spark, sf_dir):
    """Unique keys counted while they arrive, and the round numbers that were reported."""
    reports: list[int] = []
    listener = UniqueProgress(report=reports.append)
    spark.streams.addListener(listener)
    try:
        _land_events(spark, sf_dir)
        listener.ended.wait(60)  # progress comes a little after the batches
    finally:
        spark.streams.removeListener(listener)
    rows = [("unique", listener.total), ("reports", len(reports)), ("last", max(reports, default=0))]
    return spark.createDataFrame(rows, "name string, n long")


# --- files ------------------------------------------------------------------------------------------


def page_files(spark, sf_dir):
    """A file per page in one folder: a folder per page would have to be listed one by one."""
    path = scratch_path(spark, "pages")
    lines = F.array_join(F.sort_array(F.collect_list(F.coalesce("html", F.lit("")))), "\n")
    pages = table(spark, sf_dir, "pages").groupBy("page_id").agg(lines.alias("html"))
    pages.select("html").write.option("maxRecordsPerFile", 1).text(path)
    return raw_source.read_pages(spark, path).select("text")


def _numbered_files(spark, sf_dir) -> str:
    """A file of raw lines per order priority, in the order of the keys."""
    path = scratch_path(spark, "numbered")
    lines = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").substr(1, 1).alias("priority"), F.concat(F.lit('{"id":'), text("o_orderkey"), F.lit("}")).alias("value"),
        "o_orderkey",
    )
    ordered = lines.repartition("priority").sortWithinPartitions("priority", "o_orderkey")
    ordered.select("value", "priority").write.partitionBy("priority").text(path)
    return path


def _numbers(lines):
    parts = F.split("file_path", "/")
    return lines.select(F.element_at(parts, -2).alias("folder"), "line_no", "value")


def line_numbers(spark, sf_dir):
    return _numbers(numbered.read_numbered(spark, _numbered_files(spark, sf_dir)))


def stream_line_numbers(spark, sf_dir):
    """The same from a stream that takes two files at a time."""
    out, state = scratch_path(spark, "numbered-out"), scratch_path(spark, "numbered-state")
    path = _numbered_files(spark, sf_dir)
    numbered.land_numbered(spark, f"{path}/*", out, state, max_files=2).awaitTermination()
    return _numbers(spark.read.parquet(out).drop("batch"))


CSV_PARTS = 4


def csv_in_splits(spark, sf_dir):
    """Texts with quotes and line feeds through CSV files that are read in splits.

    A file takes what up to ``CSV_PARTS`` tasks read, so it is larger than a split, but no file
    and no task takes a share of the table that grows with it.
    """
    path = scratch_path(spark, "split-csv")
    rows = table(spark, sf_dir, "documents").select(text("doc_id").alias("doc_id"), F.replace("text", F.lit("e"), F.lit('"\n')).alias("text"))
    sinks.write_csv(rows.coalesce(-(-rows.rdd.getNumPartitions() // CSV_PARTS)), path)
    return read_csv_split(spark, path, rows.columns).withColumn("text", F.md5("text"))


def traffic_file(spark, sf_dir):
    path = scratch_path(spark, "traffic")
    derive.traffic(spark, sf_dir).select(
        F.col("event_id").cast("double").alias("t"), "method", "url", "status", "content_type", "body"
    ).write.json(path)
    return raw_source.read_traffic(spark, path)


def stamped_runs(spark, sf_dir):
    """Outputs of several runs side by side, told apart by their stamp."""
    base = scratch_path(spark, "stamped")
    for stamp, kind in (("20240101_000000", "customer"), ("20240102_000000", "supplier")):
        rows = table(spark, sf_dir, kind)
        sinks.write_table(rows.select(F.col(rows.columns[0]).alias("id")), sinks.run_path(base, "ids", stamp))
    return spark.read.option("basePath", f"{base}/ids").parquet(f"{base}/ids").select("id", F.col("run_ts").cast("string"))


def format_round_trip(spark, sf_dir):
    """The same rows through every file format."""
    base = scratch_path(spark, "formats")
    rows = table(spark, sf_dir, "part").select(text("p_partkey").alias("id"), F.concat(F.lit('a"b, '), "p_name").alias("name"))
    back = []
    for fmt in ("parquet", "orc", "json", "csv"):
        sinks.write_table(rows, f"{base}/{fmt}", fmt)
        if fmt == "csv":
            found = raw_source.read_csv(spark, f"{base}/{fmt}", rows.columns)
        else:
            found = spark.read.schema(rows.schema).format(fmt).load(f"{base}/{fmt}")
        back.append(found.select(F.lit(fmt).alias("fmt"), "id", "name"))
    out = back[0]
    for part in back[1:]:
        out = out.unionByName(part)
    return out


def export_round_trip(spark, sf_dir):
    """The concatenable export: header with its mark, rows in order."""
    path = scratch_path(spark, "export")
    rows = table(spark, sf_dir, "nation").select("n_nationkey", text("n_nationkey").alias("id"), F.col("n_name").alias("city"))
    sinks.export_csv(rows, path, ["n_nationkey"])
    header = spark.read.text(f"{path}/header")
    return header.unionByName(spark.read.text(f"{path}/rows"))


EDGE_QUERIES = {
    f.__name__: f
    for f in (
        repeated_keys, scalar_texts, lenient_attempts, rejected_lines, session_elapsed_nulls, late_attempts,
        delta_null_ids, json_blank_country, alias_beside_name, known_ids_any_kind, known_ids_joined, frequent_words,
        frequent_keys, ids_over_runs, merged_schema, open_leaf_texts,
        run_records, run_counts, run_rejects, empty_run, stream_equals_batch, stream_first_arrivals,
        stream_progress, line_numbers, stream_line_numbers,
        csv_in_splits, page_files, traffic_file,
        stamped_runs, format_round_trip, export_round_trip,
    )
}
