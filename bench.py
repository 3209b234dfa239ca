"""Headline queries over $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from recordlake.operators.flatten import flatten_records
from recordlake.operators.unwrap import explode_records
from recordlake.plans import derive
from recordlake.plans.queries import QUERIES
from recordlake.plans.run import run_batch
from recordlake.session import RECOMMENDED_CONF, scratch_path

HEADLINE = [
    "clean_text", "unwrap_records", "flatten_customers", "free_form_arrays", "joined_types",
    "ingest_documents", "dedupe_first", "fill_rates", "quality_summary", "country_counts",
    "type_counts", "batch_plan", "batch_status", "coverage", "lookup_details", "link_extract",
    "keyword_context", "known_id_search", "numeric_leaf_texts", "session_elapsed",
    "response_shapes", "nested_id_paths", "snapshot_delta", "stream_dedupe",
]


def session(cpus: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("recordlake-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", cpus)
    )
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def write_envelopes(spark: SparkSession, sf_dir: str, path: str) -> int:
    """Customers and documents as raw lines: the input of the complete run."""
    customers = derive.customer_lines(spark, sf_dir).select("value")
    lines = customers.unionByName(derive.document_lines(spark, sf_dir).select("value"))
    lines.unionByName(derive.junk_lines(spark, sf_dir)).repartition(8).write.text(path)
    return spark.read.text(path).select(F.sum(F.octet_length("value"))).first()[0]


def write_many_lines(spark: SparkSession, sf_dir: str, path: str, least: int = 120_000) -> int:
    """Customer lines, repeated until there are enough of them, in eight files."""
    lines = derive.customer_lines(spark, sf_dir).select("value")
    times = max(1, -(-least // lines.count()))
    copies = lines.select(F.explode(F.array_repeat("value", times)).alias("value"))
    copies.repartition(8).write.text(path)
    return spark.read.text(path).count()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session(cpus)
    spark.range(1000).selectExpr("sum(id)").collect()
    times = {
        name: timed(lambda: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save())
        for name in HEADLINE
    }
    work = scratch_path(spark, "bench")
    size = write_envelopes(spark, sf_dir, f"{work}/in")
    done = {}
    times["complete_run"] = timed(
        lambda: done.update(r=run_batch(spark, f"{work}/in", f"{work}/out", "bench"))
    )
    parsed = done["r"].parsed
    n_lines = write_many_lines(spark, sf_dir, f"{work}/lines")

    def flatten_lines():
        flat = flatten_records(explode_records(spark.read.text(f"{work}/lines")))
        flat.write.format("noop").mode("overwrite").save()

    raw_lines = [timed(flatten_lines) for _ in range(3)]
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
                "complete_run": {
                    "records": parsed,
                    "raw_bytes": size,
                    "records_per_sec": round(parsed / times["complete_run"], 1),
                },
                "raw_lines": {
                    "lines": n_lines,
                    "first_sec": raw_lines[0],
                    "second_sec": raw_lines[1],
                    "third_sec": raw_lines[2],
                    "lines_per_sec_per_core": round(n_lines / min(raw_lines[1:]) / int(cpus), 1),
                },
            }
        )
    )


if __name__ == "__main__":
    main()
