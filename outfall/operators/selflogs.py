"""Log rows about a drain itself, for the owner of the app.

Each has ``source_id`` (the app), ``source_type``, ``instance_id`` and ``payload``. LGR rows
come from the platform; SYS rows carry the index of the worker that ran into the problem.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outfall.functions import urls
from outfall.operators.validation import BLOCKED, PARSE, UNRESOLVED

# Fixed texts.
INVALID_URL = "Invalid syslog drain URL: parse failure"
UNRESOLVED_HOST = "Failed to resolve syslog drain host: "
BLOCKED_HOST = "Syslog drain blacklisted: "
INVALID_DRAIN_TYPE = "Invalid drain-type"
MESSAGES_LOST = " messages lost in user provided syslog drain"
NOT_SCHEDULED = "Syslog adapter has failed to schedule your drain stream"


def _rows(df: DataFrame, payload: Column, source_type: str, instance: Column) -> DataFrame:
    return df.select(
        F.col("app_id").alias("source_id"),
        F.lit(source_type).alias("source_type"),
        instance.alias("instance_id"),
        payload.alias("payload"),
    )


def _platform_and_worker_rows(df: DataFrame, payload: Column, index: str) -> DataFrame:
    both = F.array(
        F.struct(F.lit("LGR").alias("source_type"), F.lit("").alias("instance_id")),
        F.struct(F.lit("SYS").alias("source_type"), F.lit(index).alias("instance_id")),
    )
    return (
        df.select(F.col("app_id").alias("source_id"), payload.alias("payload"), F.explode(both).alias("e"))
        .select("source_id", "e.source_type", "e.instance_id", "payload")
    )


def reject_logs(validated: DataFrame) -> DataFrame:
    """One row per binding that failed a check; a scheme that is not allowed is not reported."""
    reason = F.col("reject_reason")
    payload = (
        F.when(reason == PARSE, INVALID_URL)
        .when(reason == UNRESOLVED, F.concat(F.lit(UNRESOLVED_HOST), "host"))
        .when(reason == BLOCKED, F.concat(F.lit(BLOCKED_HOST), "host", F.lit(" ("), "ip", F.lit(")")))
    )
    reported = validated.filter(reason.isin(PARSE, UNRESOLVED, BLOCKED))
    return _rows(reported, payload, "LGR", F.lit(""))


def unreadable_drain_logs(bindings: DataFrame, index: str) -> DataFrame:
    """A worker that cannot read a drain URL says so twice. It does not mind a missing host."""
    bad = bindings.filter(~urls.is_readable(F.col("drain")))
    return _platform_and_worker_rows(bad, F.lit(INVALID_URL), index)


def drain_type_logs(selected: DataFrame, index: str) -> DataFrame:
    """A URL that cannot be read has no drain type to complain about."""
    return _rows(
        selected.filter(~F.col("drain_type_ok") & urls.is_readable(F.col("drain"))), F.lit(INVALID_DRAIN_TYPE), "SYS", F.lit(index)
    )


def lost_message_logs(lost: DataFrame, index: str) -> DataFrame:
    payload = F.concat(F.col("missed").cast("string"), F.lit(MESSAGES_LOST))
    return _platform_and_worker_rows(lost, payload, index)


def not_scheduled_logs(rejects: DataFrame) -> DataFrame:
    """``rejects`` of the worker cap; the worker is the instance."""
    return _rows(rejects, F.lit(NOT_SCHEDULED), "LGR", F.col("worker"))


#: The tag of envelopes that are self-logs, from which no further ones are made.
SELF_TAG = "self_log"


def as_envelopes(self_logs: DataFrame, timestamp_ns: Column, env_id: Column) -> DataFrame:
    """Self-logs in the envelope schema, to go out through the app's own drains."""
    tags = F.create_map(F.lit("source_type"), F.col("source_type"), F.lit(SELF_TAG), F.lit("1"))
    return self_logs.select(
        env_id.alias("env_id"),
        "source_id",
        "instance_id",
        timestamp_ns.cast("long").alias("timestamp_ns"),
        tags.alias("tags"),
        F.lit("log").alias("kind"),
        F.struct(F.col("payload").cast("binary").alias("payload"), F.lit("ERR").alias("type")).alias("log"),
        F.lit(None).cast("struct<metrics:map<string,struct<unit:string,value:double>>>").alias("gauge"),
        F.lit(None).cast("struct<name:string,total:decimal(20,0),delta:decimal(20,0)>").alias("counter"),
    )


def is_self_log() -> Column:
    return F.coalesce(F.try_element_at("tags", F.lit(SELF_TAG)) == "1", F.lit(False))


def with_self_logs(envelopes: DataFrame, self_log_envelopes: DataFrame) -> DataFrame:
    return envelopes.unionByName(self_log_envelopes)
