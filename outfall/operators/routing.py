"""Envelopes to messages: one per envelope, binding and metric."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outfall.functions import rfc5424, urls
from outfall.operators.selflogs import is_self_log
from outfall.operators.skew import BROADCAST_BYTES, skew_join
from outfall.schema import BINDING_KEY

#: Kinds that give messages; all others (timers, events) are carried but give none.
RENDERED_KINDS = ("log", "gauge", "counter")


def rendered_kinds(envelopes: DataFrame) -> DataFrame:
    return envelopes.filter(F.col("kind").isin(*RENDERED_KINDS))


def prerender(envelopes: DataFrame, trim_fraction: bool = False) -> DataFrame:
    """Render everything that does not depend on the binding, once per envelope.

    An envelope that fans out to many drains is formatted once, and what the join then carries
    is ready text instead of the nested message. One row per message: a gauge envelope has one
    for each metric, numbered by ``part``; one without metrics keeps a row without
    ``has_message``, because it takes up room in a buffer all the same.

    The lambda in the gauge text keeps this projection out of the generated code of the join
    that follows. As a part of that code it would be put off to the join's inner loop, and be
    done over for every binding, in a method too long for the JIT compiler.
    """
    is_log, is_gauge = F.col("kind") == "log", F.col("kind") == "gauge"
    flat = rendered_kinds(envelopes).select(
        "*", F.posexplode_outer(F.when(is_gauge, F.col("gauge.metrics"))).alias("part", "key", "reading")
    )
    priority = F.when(is_log, rfc5424.priority(F.col("log.type"))).otherwise(rfc5424.PRIORITY_OUT)
    process_id = F.when(
        is_log,
        rfc5424.log_process_id(F.try_element_at("tags", F.lit("source_type")), F.col("instance_id")),
    ).otherwise(rfc5424.metric_process_id(F.col("instance_id")))
    structured = F.when(
        is_gauge, rfc5424.gauge_sd(F.col("key"), F.col("reading.value"), F.col("reading.unit"))
    ).when(
        ~is_log,
        rfc5424.counter_sd(F.col("counter.name"), F.col("counter.total"), F.col("counter.delta")),
    )
    text = F.when(is_log, rfc5424.log_text(F.col("log.payload"))).otherwise("\n")
    return flat.select(
        "env_id",
        "source_id",
        "kind",
        "timestamp_ns",
        F.coalesce("part", F.lit(0)).alias("part"),
        F.when(is_gauge, F.col("key")).when(~is_log, F.col("counter.name")).alias("metric"),
        rfc5424.head(priority, rfc5424.timestamp_text(F.col("timestamp_ns"), trim_fraction)).alias("head"),
        rfc5424.tail(F.col("source_id"), process_id, structured, text).alias("tail"),
        (~is_gauge | F.col("key").isNotNull()).alias("has_message"),
        is_self_log().alias("is_self"),
        (
            rfc5424.is_valid_part(F.col("source_id"), rfc5424.MAX_APP_NAME)
            & rfc5424.is_valid_part(process_id, rfc5424.MAX_PROCESS_ID)
        ).alias("env_valid"),
    )


def fan_out(
    envelopes: DataFrame,
    bindings: DataFrame,
    spread_by: list[str] | None = None,
    max_broadcast_bytes: int = BROADCAST_BYTES,
    heat: DataFrame | None = None,
    is_settled: bool = False,
) -> DataFrame:
    """Every envelope with every binding of its app that selects its kind.

    ``bindings`` has ``kinds`` (see ``with_kinds``). ``heat`` (``source_id``, ``n``) says how many envelopes of an app a
    micro-batch has, where ``envelopes`` is a stream, and ``is_settled`` that they are a written table. Apps match by equality, so an envelope can
    never reach a binding of another app. What depends on the binding alone, ``scheme`` and
    ``binding_valid``, is worked out here, before a row of it is copied for each envelope.
    """
    targets = bindings.select(
        F.col("app_id").alias("source_id"),
        *[c for c in bindings.columns if c != "app_id"],
        F.coalesce(urls.scheme(F.col("drain")), F.lit("")).alias("scheme"),
        rfc5424.is_valid_part(F.col("hostname"), rfc5424.MAX_HOSTNAME).alias("binding_valid"),
    )
    joined = skew_join(
        envelopes, targets, ["source_id"], spread_by or ["env_id"], "inner", max_broadcast_bytes, heat, is_settled=is_settled
    )
    return joined.filter(F.array_contains(F.col("kinds"), F.col("kind"))).withColumn(
        "app_id", F.col("source_id")
    )


def by_choice(bindings: DataFrame) -> DataFrame:
    """One row for the bindings of an app that get the same envelopes, and in ``bindings`` how many they are.

    For counting what ``fan_out`` would give without making its rows. Hostname and drain are those of one of them.
    """
    alike = [c for c in ("app_id", "kinds", "replicas", "replica") if c in bindings.columns]
    some = [F.min(c).alias(c) for c in BINDING_KEY if c not in alike]
    return bindings.groupBy(*alike).agg(*some, F.count(F.lit(1)).alias("bindings"))


def own_envelopes(routed: DataFrame) -> DataFrame:
    """Of envelopes that were already paired with a binding, those of the binding's app."""
    return routed.filter(F.col("source_id") == F.col("app_id"))


def replica(envelope_key: Column, replicas: int | Column) -> Column:
    """The one of a drain's replicas that sends this envelope."""
    first = F.conv(F.substring(F.md5(envelope_key.cast("string").cast("binary")), 1, 8), 16, 10)
    count = F.lit(replicas) if isinstance(replicas, int) else replicas
    return F.pmod(first.cast("long"), count.cast("long"))


def shares(assignment: DataFrame, worker: str) -> DataFrame:
    """The bindings of one worker, with ``replicas``, how many workers have the binding, and ``replica``, its number among them."""
    by_binding = assignment.groupBy(*BINDING_KEY).agg(F.array_sort(F.collect_set("worker")).alias("_workers"))
    return by_binding.filter(F.array_contains("_workers", worker)).select(
        *BINDING_KEY,
        F.size("_workers").alias("replicas"),
        (F.array_position("_workers", worker) - 1).cast("long").alias("replica"),
    )


def own_share(routed: DataFrame) -> DataFrame:
    """Of envelopes with bindings, those that this replica sends. Without replicas that is all of them."""
    if "replicas" not in routed.columns:
        return routed
    return routed.filter(replica(F.col("env_id"), F.col("replicas")) == F.col("replica"))


def render(routed: DataFrame) -> DataFrame:
    """Prerendered envelopes, joined with their bindings, as one row per message.

    ``frame`` has the octet count that stream transports need, and is the bare message for
    https. ``is_valid`` is false where the header breaks a limit of the format.
    """
    text = rfc5424.message(F.col("head"), F.col("hostname"), F.col("tail"))
    return (
        routed.filter("has_message")
        .withColumn("message", text)
        .select(
            "env_id",
            *BINDING_KEY,
            "timestamp_ns",
            "scheme",
            "part",
            "metric",
            (F.col("env_valid") & F.col("binding_valid")).alias("is_valid"),
            F.when(F.col("scheme") == "https", F.col("message"))
            .otherwise(rfc5424.frame(F.col("message")))
            .alias("frame"),
        )
    )
