"""Nested inputs that Spark derives row by row from the flat test tables.

No table holds nested responses, so the registered queries first turn whole tables into
raw JSON lines. Every line is built from one row: no grouping, no shuffle, no sampling.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordlake.session import built_once, small_batches

JSON_NULLS = {"ignoreNullFields": "false"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def json_text(value: Column) -> Column:
    return F.to_json(value, JSON_NULLS)


def wrap(record: Column) -> Column:
    """One record as the only item of a response body."""
    return F.concat(F.lit('{"url":"/details","body":['), record, F.lit("]}"))


def customer_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with the names of their nation and region."""
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    named = customer.join(nation, customer.c_nationkey == nation.n_nationkey)
    return named.join(region, named.n_regionkey == region.r_regionkey)


def longitude_text() -> Column:
    """Coordinates of every kind: numbers, padded numbers, exponents, words, blanks."""
    return (
        F.when(F.col("c_mktsegment") == "BUILDING", "n/a")
        .when(F.col("c_mktsegment") == "FURNITURE", "")
        .when(F.col("c_mktsegment") == "HOUSEHOLD", "  12.5 ")
        .when(F.col("c_mktsegment") == "MACHINERY", "1e3")
        .otherwise(F.col("c_acctbal").cast("string"))
    )


@built_once
def customer_record() -> Column:
    """A customer as a nested directory record, as JSON text."""
    key, segment = F.col("c_custkey").cast("string"), F.col("c_mktsegment")
    positive = F.col("c_acctbal") > 0
    contact = F.struct(
        F.concat(F.lit(" mail"), key, F.lit("@example.org")).alias("email"),
        F.lit(None).cast("string").alias("phone"),
    )
    descriptions = F.array(
        F.struct(F.lit("").alias("description"), F.lit(True).alias("isDefault")),
        F.struct(F.lower(segment).alias("description"), positive.alias("isDefault")),
        F.struct(F.col("n_name").alias("description"), F.lit(True).alias("isDefault")),
    )
    details = F.struct(
        F.initcap(segment).alias("firstName"),
        F.lit(None).cast("string").alias("lastName"),
        F.concat(F.col("c_name"), F.lit(" of\n"), F.col("r_name")).alias("about"),
        contact.alias("partnerContact"),
        descriptions.alias("descriptions"),
    )
    types = F.array(
        F.struct(F.substring(segment, 1, 3).alias("code"), F.concat(segment, F.lit(" ")).alias("name")),
        F.struct(F.lit("").alias("code"), F.lit("Trade").alias("name")),
        F.struct(F.lit("false").alias("code"), F.lit(None).cast("string").alias("name")),
    )
    levels = F.array(
        F.struct(
            F.lit(None).cast("string").alias("logoUrl"),
            F.col("r_name").alias("globalProgramLevelId"),
            F.col("n_regionkey").alias("displayRank"),
            positive.alias("b2cAvailable"),
        ),
        F.struct(
            F.lit("x").alias("logoUrl"),
            F.lit("SECOND").alias("globalProgramLevelId"),
            F.lit(9).alias("displayRank"),
            F.lit(True).alias("b2cAvailable"),
        ),
    )
    hours = F.array(F.struct(F.col("n_name").alias("day"), F.col("c_nationkey").alias("open")))
    return json_text(
        F.struct(
            F.col("c_custkey").alias("id"),
            F.concat(F.lit("BFO-"), key).alias("accountBfoId"),
            F.lit(None).cast("string").alias("idGroup"),
            F.concat(F.lit("  "), F.col("c_name"), F.lit("\t")).alias("companyName"),
            F.concat(key, F.lit("\n"), F.col("r_name"), F.lit(" Street")).alias("address1"),
            F.concat(F.lit("City "), F.col("c_nationkey").cast("string")).alias("city"),
            F.lpad(key, 9, "0").alias("zipCode"),
            F.col("r_name").alias("administrativeRegion"),
            F.col("n_name").alias("country"),
            F.col("n_nationkey").alias("countryId"),
            F.col("c_acctbal").alias("latitude"),
            longitude_text().alias("longitude"),
            F.concat(F.lit("https://example.org/"), key).alias("webSite"),
            F.lit("  ").alias("logoUrl"),
            positive.alias("emailExists"),
            F.lit(False).alias("phoneExists"),
            F.lower(segment).alias("openingHoursType"),
            (segment == "BUILDING").alias("eshop"),
            F.col("c_nationkey").alias("productCount"),
            F.when(positive, details).alias("partnerDetails"),
            types.alias("businessType"),
            F.when(positive, levels).otherwise(F.slice(levels, 1, 0)).alias("programLevels"),
            hours.alias("openingHours"),
            F.slice(hours, 1, 0).alias("competence"),
        )
    )


def customer_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw line per customer, in five response shapes by market segment."""
    record = F.col("record")
    shaped = (
        F.when(F.col("c_mktsegment") == "AUTOMOBILE", wrap(record))
        .when(
            F.col("c_mktsegment") == "BUILDING",
            F.concat(F.lit('{"body":{"items":['), record, F.lit(',5,"{\\"id\\":1}",null,[1]]}}')),
        )
        .when(
            F.col("c_mktsegment") == "FURNITURE",
            F.concat(F.lit('{"body":{"items":[],"data":{"id":0},"results":['), record, F.lit("]}}")),
        )
        .when(F.col("c_mktsegment") == "HOUSEHOLD", F.concat(F.lit('{"body":'), record, F.lit("}")))
        .otherwise(F.concat(F.lit('{"partners":['), record, F.lit("]}")))
    )
    facts = customer_facts(spark, sf_dir).withColumn("record", customer_record())
    return facts.select("c_custkey", "c_mktsegment", shaped.alias("value"))


def junk_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines without any record, a few kinds for each nation."""
    name = F.col("n_name")
    kinds = F.array(
        F.concat(F.lit('{"body":{"code":"E","message":"'), name, F.lit('"}}')),
        F.concat(F.lit('{"body":"'), name, F.lit('"}')),
        F.lit('{"body":null}'),
        F.concat(F.lit("[5,\""), name, F.lit('"]')),
        name,
    )
    return table(spark, sf_dir, "nation").select(F.explode(kinds).alias("value"))


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document as a record whose lists are the lines of its whole text."""
    lines = F.split(F.col("text"), "\n")
    record = F.struct(
        F.col("doc_id").alias("id"),
        F.col("lang").alias("country"),
        F.col("source").alias("city"),
        F.col("text").alias("companyName"),
        F.struct(
            F.transform(
                lines,
                lambda t: F.struct(
                    t.alias("description"), F.contains(t, F.lit(",")).alias("isDefault")
                ),
            ).alias("descriptions")
        ).alias("partnerDetails"),
        F.transform(
            lines, lambda t: F.struct(t.alias("code"), F.concat(F.lit(" "), t).alias("name"))
        ).alias("businessType"),
    )
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", wrap(json_text(record)).alias("value"))


def part_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each part as a record with two program levels, none for the economy type."""
    level = F.struct(
        F.col("p_name").alias("logoUrl"),
        F.col("p_brand").alias("globalProgramLevelId"),
        F.col("p_size").alias("displayRank"),
        (F.col("p_retailprice") > 1000).alias("b2cAvailable"),
    )
    other = F.struct(
        F.lit("second").alias("logoUrl"),
        F.col("p_type").alias("globalProgramLevelId"),
        F.lit(0).alias("displayRank"),
        F.lit(False).alias("b2cAvailable"),
    )
    both = F.array(level, other)
    words = F.transform(F.split("p_name", " "), lambda w: F.struct(w.alias("code"), w.alias("name")))
    record = F.struct(
        F.col("p_partkey").alias("id"),
        F.when(F.col("p_type") == "ECONOMY", F.slice(both, 1, 0)).otherwise(both).alias("programLevels"),
        words.alias("businessType"),
    )
    return table(spark, sf_dir, "part").select("p_partkey", wrap(json_text(record)).alias("value"))


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns read as fetch attempts of one batch per conversation."""
    text, turn = F.col("text"), F.col("turn")
    body = (
        F.when(F.col("role") == "system", F.lit(None).cast("string"))
        .when(F.col("role") == "user", text)
        .when(F.contains(text, F.lit("\n")), json_text(F.array(F.struct(turn.alias("id"), text.alias("name")))))
        .when(F.contains(text, F.lit(",")), F.lit('{"items":[]}'))
        .otherwise(text)
    )
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("batch_idx"),
        turn.alias("attempt"),
        F.when(F.col("role") == "user", 500).when(F.col("role") == "assistant", 200).alias("status"),
        F.when(F.col("role") == "system", "connection reset").alias("error"),
        body.alias("body"),
    )


def traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events read as a captured traffic log."""
    kind = F.col("event_type")
    user = F.col("user_id").cast("string")
    url = F.concat(
        F.lit("https://example.org/api/"), kind, F.lit("?countryCode="), user,
        F.lit("&ts="), F.col("event_id").cast("string"),
    )
    body = (
        F.when(kind == "view", F.col("props"))
        .when(kind == "click", F.concat(F.lit("["), F.col("props"), F.lit(","), F.col("props"), F.lit("]")))
        .when(kind == "error", F.concat(F.lit('{"code":"E'), user, F.lit('","detail":null}')))
        .when(kind == "purchase", F.concat(F.lit('{"count":'), user, F.lit(',"ids":[1,2,'), user, F.lit("]}")))
        .otherwise(F.concat(F.lit("signup of "), user))
    )
    return table(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        "user_id",
        F.when(kind.isin("purchase", "signup"), "POST").otherwise("GET").alias("method"),
        url.alias("url"),
        F.when(kind == "error", 500).otherwise(200).alias("status"),
        F.when(kind.isin("view", "purchase", "error"), "application/json")
        .when(kind == "click", "text/javascript")
        .otherwise("text/html")
        .alias("content_type"),
        body.alias("body"),
    )


def vector_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as whole-number lists at several depths of one JSON document."""
    numbers = F.transform("embedding", lambda x: F.floor(x.cast("double") * 1000))
    label = F.col("label")
    body = F.struct(
        numbers.alias("vals"),
        F.slice(numbers, 1, 10).alias("ids"),
        F.struct(
            F.struct(
                numbers.alias("ids"), F.struct(F.struct(numbers.alias("ids")).alias("too")).alias("far")
            ).alias("deep"),
            F.array(F.struct(numbers.alias("ids"))).alias("list"),
            F.transform(numbers, lambda n: n.cast("string")).alias("Countries"),
            F.slice(numbers, 1, 11).alias("allCountries"),
        ).alias("store"),
        label.alias("count"),
    )
    return table(spark, sf_dir, "embeddings").select("vec_id", "label", json_text(body).alias("body"))
