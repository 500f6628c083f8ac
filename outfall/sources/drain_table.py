"""The drain table: landed API pages, and the worker and range lists of the configuration.

The API is paged by ``next_id``. Whatever fetches it lands every response as one row of
``requested_id``, ``status`` and ``body``; the functions here check and read what was landed.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from outfall.functions.addresses import ip_bytes
from outfall.schema import LANDED_PAGE, PAGE_BODY
from outfall.session import settle

#: Apps asked for per page.
PAGE_SIZE = 1000


class IncompleteSnapshot(ValueError):
    """The landed pages are not one whole, valid chain. Nothing of them may be used."""


def page_url(base: str, next_id: Column, page_size: int = PAGE_SIZE) -> Column:
    """The address to fetch a page from."""
    return F.format_string(
        f"{base.replace('%', '%%')}/internal/v4/syslog_drain_urls?batch_size={page_size}&next_id=%d", next_id
    )


def read_pages(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    return spark.read.schema(LANDED_PAGE).format(fmt).load(path)


def parse_pages(landed: DataFrame) -> DataFrame:
    """Add ``results``, ``next_id`` (0 on the last page) and ``problem`` (null if good)."""
    schema = PAGE_BODY.jsonValue()
    schema["fields"].append({"name": "_bad", "type": "string", "nullable": True, "metadata": {}})
    parsed = F.from_json(
        "body", type(PAGE_BODY).fromJson(schema), {"columnNameOfCorruptRecord": "_bad"}
    )
    is_null_text = F.trim("body") == "null"
    bad = ~is_null_text & (F.col("_page").isNull() | F.col("_page._bad").isNotNull())
    return landed.withColumn("_page", parsed).select(
        "requested_id",
        "status",
        F.col("_page.results").alias("results"),
        F.coalesce("_page.next_id", F.lit(0).cast("long")).alias("next_id"),
        F.when(
            F.coalesce("status", F.lit(0)) != 200,
            F.concat(
                F.lit("received "),
                F.coalesce(F.col("status").cast("string"), F.lit("no")),
                F.lit(" status code from syslog drain binding API"),
            ),
        )
        .when(F.coalesce(bad, F.lit(True)), "invalid API response body")
        .alias("problem"),
    )


def check_pages(pages: DataFrame) -> None:
    """Raise ``IncompleteSnapshot`` unless the pages are one chain from page 0 to a last page.

    Every page but the first must be asked for by exactly one other page, and every page asked
    for must be there. Those are counts over the page ids. What they cannot tell from a chain
    is a chain with a ring beside it, and a ring has a page that asks for an earlier one.
    """
    ids = pages.select("requested_id", "next_id", "problem")
    referred = ids.filter(F.col("next_id") != 0).groupBy("next_id").agg(F.count(F.lit(1)).alias("refs"))
    landed = ids.groupBy("requested_id").agg(F.count(F.lit(1)).alias("copies"))
    links = landed.join(referred, landed.requested_id == referred.next_id, "full").agg(
        F.count_if(F.coalesce("copies", F.lit(0)) != 1).alias("not_once"),
        F.count_if(
            (F.col("requested_id") != 0) & (F.coalesce("refs", F.lit(0)) != 1)
        ).alias("not_referred_once"),
    )
    facts = ids.agg(
        F.min("problem").alias("problem"),
        F.count_if(F.col("requested_id") == 0).alias("first_pages"),
        F.count_if(F.col("next_id") == 0).alias("last_pages"),
        F.count_if((F.col("next_id") != 0) & (F.col("next_id") <= F.col("requested_id"))).alias("back"),
        F.count(F.lit(1)).alias("pages"),
    ).first()
    if facts["problem"]:
        raise IncompleteSnapshot(facts["problem"])
    if facts["first_pages"] != 1 or facts["last_pages"] != 1:
        raise IncompleteSnapshot("no single first and last page")
    link_faults = links.first()
    if link_faults["not_once"] or link_faults["not_referred_once"]:
        raise IncompleteSnapshot("a page is missing, doubled or not part of the chain")
    if facts["back"] and not _reaches_end(ids, facts["pages"]):
        raise IncompleteSnapshot("the pages run in a ring")


def _reaches_end(ids: DataFrame, pages: int) -> bool:
    """Follow all links at once, twice as far in every round, until only the end is left."""
    hops = settle(ids.select(F.col("requested_id").alias("at"), F.col("next_id").alias("to")))
    for _ in range(math.ceil(math.log2(max(pages, 2))) + 1):
        # Id 0 as a target means the end; page 0 itself is nobody's next page.
        onward = hops.filter(F.col("at") != 0).select(F.col("at").alias("to"), F.col("to").alias("further"))
        hops = settle(
            hops.join(onward, "to", "left").select("at", F.coalesce("further", F.lit(0)).alias("to"))
        )
    return hops.filter(F.col("to") != 0).isEmpty()


def page_bindings(pages: DataFrame) -> DataFrame:
    """One row per app and drain. An app without drains gives none; doubles are kept."""
    return (
        pages.select(F.explode("results").alias("app_id", "_app"))
        .select("app_id", F.col("_app.hostname").alias("hostname"), F.explode("_app.drains").alias("drain"))
        .select("app_id", F.coalesce("hostname", F.lit("")).alias("hostname"), F.coalesce("drain", F.lit("")).alias("drain"))
    )


def fetch_bindings(landed: DataFrame) -> DataFrame:
    """The bindings of a whole snapshot, or ``IncompleteSnapshot``: never a part of one."""
    # The bodies are parsed once, for the checks and for the bindings.
    pages = settle(parse_pages(landed))
    check_pages(pages)
    return page_bindings(pages)


def parse_ranges(texts: DataFrame, column: str = "ranges", keep: list[str] | None = None) -> DataFrame:
    """Ranges ``start``, ``end``, ``start16``, ``end16`` from texts such as ``a-b,c-d``.

    An empty text has none. The first fault of a text fails the job, with its reason. Other
    columns of the texts can be kept by name.
    """
    pieces = F.split(column, ",", -1)
    malformed = F.get(F.filter(pieces, lambda p: F.size(F.split(p, "-", -1)) != 2), F.lit(0))
    start, end = F.col("start"), F.col("end")
    bad_address = F.lit("invalid IP Address for Blacklist IP Range: ")
    problem = (
        F.when(F.col("start16").isNull(), F.concat(bad_address, start))
        .when(F.col("end16").isNull(), F.concat(bad_address, end))
        .when(
            F.col("start16") > F.col("end16"),
            F.concat(
                F.lit("invalid Blacklist IP Range: Start "), start, F.lit(" has to be before End "), end
            ),
        )
    )
    # All pieces are split before the first address is read.
    return (
        texts.filter(F.col(column) != "")
        .filter(_none_or_fail(F.concat(F.lit("invalid BlacklistRange: "), malformed)))
        .select(*(keep or []), F.explode(pieces).alias("_piece"))
        .withColumn("start", F.split_part("_piece", F.lit("-"), F.lit(1)))
        .withColumn("end", F.split_part("_piece", F.lit("-"), F.lit(2)))
        .drop("_piece")
        .withColumn("start16", ip_bytes(start))
        .withColumn("end16", ip_bytes(end))
        .filter(_none_or_fail(problem))
    )


def _none_or_fail(problem: Column) -> Column:
    return F.when(problem.isNull(), True).otherwise(F.raise_error(problem).cast("boolean"))


def worker_addresses(hosts: DataFrame, dns: DataFrame, port: str) -> DataFrame:
    """``ip:port`` of every address of every host, each once. An unknown host fails the job."""
    found = hosts.select("host").join(dns.select("host", "ip"), "host", "left")
    address = F.when(
        F.col("ip").isNull(),
        F.raise_error(F.concat(F.lit("lookup "), "host", F.lit(": no such host"))).cast("string"),
    ).otherwise(F.concat_ws(":", "ip", F.lit(port)))
    return found.select(address.alias("worker")).dropDuplicates()
