"""Envelopes, bindings, workers and address tables made from the sample tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outfall.sources.drain_table import parse_ranges


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Envelopes in a task of a fan-out, which makes some messages of each.
TASK_ENVELOPES = 50_000


def _spread(df: DataFrame, key: str) -> DataFrame:
    """Split an input of so few files that a fan-out would leave most cores idle, or give one task too many messages.

    Tables that have more splits are left as they are.
    """
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // TASK_ENVELOPES))
    return df if df.rdd.getNumPartitions() >= tasks else df.repartition(tasks, key)


def bindings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drains of all customers: six kinds of URL start, five kinds of query."""
    key = F.col("c_custkey")
    prefix = (
        F.when(key % 6 == 0, "syslog://")
        .when(key % 6 == 1, "syslog-tls://")
        .when(key % 6 == 2, "https://user:pass@")
        .when(key % 6 == 3, "http://")
        .when(key % 6 == 4, "SYSLOG://")
        .otherwise("bad:")
    )
    suffix = (
        F.when(key % 5 == 0, "")
        .when(key % 5 == 1, "/?drain-type=logs")
        .when(key % 5 == 2, "/?drain-type=metrics")
        .when(key % 5 == 3, "/?drain-type=all")
        .otherwise("/?drain-type=bogus")
    )
    host = F.concat_ws(".", F.lit("10"), "c_nationkey", key % 256, key % 200 + 1)
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("app-"), (key % 200).cast("string")).alias("app_id"),
        F.concat(F.lower("c_mktsegment"), F.lit(".space")).alias("hostname"),
        F.concat(prefix, host, F.lit(":"), (key % 3 + 514).cast("string"), suffix).alias("drain"),
        key.alias("custkey"),
    )


def envelopes(spark: SparkSession, sf_dir: str, is_spread: bool = True) -> DataFrame:
    """All events in the envelope schema: logs, gauges with two metrics, counters and timers."""
    events = table(spark, sf_dir, "events")
    key = F.col("event_id")
    kind = (
        F.when(F.col("event_type") == "purchase", "gauge")
        .when(F.col("event_type") == "signup", "counter")
        .when((F.col("event_type") == "view") & (key % 10 == 0), "timer")
        .otherwise("log")
    )
    log_type = (
        F.when(F.col("event_type") == "error", "ERR")
        .when(F.col("event_type") == "click", "OUT")
        .otherwise("OTHER")
    )
    payload = F.concat(
        "event_type",
        F.lit(" "),
        F.when(key % 7 == 0, F.char(F.lit(0))).otherwise(""),
        "props",
        F.when(key % 11 == 0, "\n").otherwise(""),
    )
    hundredths = F.round(F.col("value") * 100).cast("long")
    reading = (
        F.when(key % 3 == 0, F.col("value"))
        .when(key % 3 == 1, (hundredths * 1000).cast("double"))
        .otherwise(hundredths.cast("double") / 1e7)
    )
    unit = F.when(key % 2 == 0, "ms").otherwise('a"b]\\c')
    k = F.regexp_extract("props", r"(\d+)", 1).cast("double")
    metrics = F.create_map(
        F.lit("value"),
        F.struct(unit.alias("unit"), reading.alias("value")),
        F.lit("k"),
        F.struct(F.lit("").alias("unit"), k.alias("value")),
    )
    return (
        (_spread(events, "event_id") if is_spread else events)
        .withColumn("kind", kind)
        .select(
            key.alias("env_id"),
            F.concat(F.lit("app-"), F.col("user_id").cast("string")).alias("source_id"),
            F.when(key % 5 == 0, "").otherwise((key % 4).cast("string")).alias("instance_id"),
            (F.unix_micros(F.col("ts").cast("timestamp")) * 1000 + key % 1000).alias("timestamp_ns"),
            F.create_map(
                F.lit("source_type"), F.when(key % 3 == 0, "my task").otherwise("app")
            ).alias("tags"),
            "kind",
            F.when(
                F.col("kind") == "log",
                F.struct(payload.cast("binary").alias("payload"), log_type.alias("type")),
            ).alias("log"),
            F.when(F.col("kind") == "gauge", F.struct(metrics.alias("metrics"))).alias("gauge"),
            F.when(
                F.col("kind") == "counter",
                F.struct(
                    F.col("event_type").alias("name"),
                    (key * 10).cast("decimal(20,0)").alias("total"),
                    (key % 10).cast("decimal(20,0)").alias("delta"),
                ),
            ).alias("counter"),
        )
    )


def document_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All document texts as log payloads; a NUL byte is put in front of every third."""
    key = F.col("doc_id")
    payload = F.concat(
        F.when(key % 3 == 0, F.char(F.lit(0))).otherwise(""),
        "text",
        F.when(key % 4 == 0, "\n").otherwise(""),
    )
    return table(spark, sf_dir, "documents").select(
        key.alias("env_id"),
        F.concat(F.lit("app-"), (key % 200).cast("string")).alias("source_id"),
        (key % 4).cast("string").alias("instance_id"),
        (key * 1_000_003).alias("timestamp_ns"),
        F.create_map(F.lit("source_type"), F.lit("app")).alias("tags"),
        F.lit("log").alias("kind"),
        F.struct(payload.cast("binary").alias("payload"), F.lit("OUT").alias("type")).alias("log"),
        F.lit(None).cast("struct<metrics:map<string,struct<unit:string,value:double>>>").alias("gauge"),
        F.lit(None).cast("struct<name:string,total:decimal(20,0),delta:decimal(20,0)>").alias("counter"),
    )


def workers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven workers, of which number 3 does not answer."""
    return (
        table(spark, sf_dir, "supplier")
        .select(F.concat(F.lit("w"), (F.col("s_suppkey") % 7).cast("string")).alias("worker"))
        .dropDuplicates()
        .withColumn("healthy", F.col("worker") != "w3")
    )


def page_dns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses for the hosts of all pages, but for those whose md5 begins with 0."""
    host = F.regexp_extract("url", r"^[a-z]+://([^/?#:]*)", 1)
    digest = F.md5(F.col("host").cast("binary"))
    octets = [F.conv(F.substring(digest, i, 2), 16, 10) for i in (1, 3, 5)]
    return (
        table(spark, sf_dir, "pages")
        .select(host.alias("host"))
        .dropDuplicates()
        .filter(~digest.startswith("0"))
        .select("host", F.concat_ws(".", F.lit("10"), *octets).alias("ip"))
    )


def page_bindings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All page URLs as drains."""
    return table(spark, sf_dir, "pages").select(
        F.concat(F.lit("app-"), (F.col("page_id") % 200).cast("string")).alias("app_id"),
        F.lit("pages.space").alias("hostname"),
        F.col("url").alias("drain"),
    )


def ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocked ranges, one per nation with an even key, and a single address of one customer."""
    nations = table(spark, sf_dir, "nation").filter(F.col("n_nationkey") % 2 == 0)
    half = nations.select(
        F.concat(
            F.lit("10."), "n_nationkey", F.lit(".0.0-10."), "n_nationkey", F.lit(".127.255")
        ).alias("ranges")
    )
    single = bindings(spark, sf_dir).filter(F.col("custkey") == 1)
    address = F.regexp_extract("drain", r"(10\.\d+\.\d+\.\d+)", 1)
    one = single.select(F.concat_ws("-", address, address).alias("ranges"))
    return parse_ranges(half.unionByName(one))


def landed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The drain table as API pages of 400 customers each, all drains of an app with one hostname."""
    page = F.floor(F.col("custkey") / 400).cast("long")
    apps = (
        bindings(spark, sf_dir)
        .withColumn("page", page)
        .groupBy("page", "app_id")
        .agg(
            F.array_sort(F.collect_list("drain")).alias("drains"),
            F.min("hostname").alias("hostname"),
        )
    )
    pages = apps.groupBy("page").agg(
        F.map_from_entries(
            F.collect_list(F.struct("app_id", F.struct("drains", "hostname")))
        ).alias("results")
    )
    last = pages.agg(F.max("page").alias("last")).scalar()
    next_id = F.when(F.col("page") < last, (F.col("page") + 1) * 400)
    return pages.select(
        (F.col("page") * 400).alias("requested_id"),
        F.lit(200).alias("status"),
        F.to_json(F.struct("results", next_id.alias("next_id"))).alias("body"),
    )
