"""Counters and gauges, each as a small aggregate table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def ingress(received: DataFrame, times: str | None = None) -> DataFrame:
    """Envelopes received on the streams of bindings, foreign ones included. ``times`` is a column that says how many a row stands for."""
    number = F.coalesce(F.sum(times), F.lit(0)) if times else F.count(F.lit(1))
    return received.agg(number.alias("delta")).select(F.lit("ingress").alias("name"), "delta")


def egress(outcomes: DataFrame) -> DataFrame:
    """Messages, not envelopes, that were written, per scheme, from the outcomes of sending."""
    return (
        outcomes.filter(F.col("sent") > 0)
        .groupBy("scheme")
        .agg(F.sum("sent").cast("long").alias("delta"))
        .select(F.lit("egress").alias("name"), "scheme", "delta")
    )


def dropped(lost: DataFrame) -> DataFrame:
    """Envelopes lost to overrun buffers; failed writes are not counted here."""
    return lost.agg(F.coalesce(F.sum("missed"), F.lit(0)).alias("delta")).select(
        F.lit("dropped").alias("name"), "delta"
    )


def written(*counted: DataFrame, now: Column) -> DataFrame:
    """Counters and gauges as rows of one table: ``ts``, ``name``, ``scheme``, ``worker``, ``delta`` and ``value``.

    Each of ``counted`` has ``name`` and one of ``delta`` (of a counter) and ``value`` (of a gauge).
    """
    rows = None
    for part in counted:
        columns = {"scheme": "string", "worker": "string", "delta": "long", "value": "double"}
        filled = [(F.col(c) if c in part.columns else F.lit(None)).cast(t).alias(c) for c, t in columns.items()]
        part = part.select(now.cast("timestamp").alias("ts"), "name", *filled)
        rows = part if rows is None else rows.unionByName(part)
    return rows


def pulse_of(rows: DataFrame, interval: str = "1 minute") -> DataFrame:
    """The pulse of what ``written`` gave: names of counters by scheme, of gauges by worker, end in these."""
    name = F.concat_ws(".", "name", "scheme", "worker")
    named = rows.withColumn("name", name)
    return pulse(named.filter("delta IS NOT NULL"), named.filter("value IS NOT NULL"), interval)


def drain_bindings(assignment: DataFrame) -> DataFrame:
    return assignment.groupBy("worker").agg(F.count(F.lit(1)).alias("drain_bindings"))


def rejected_bindings(capped: DataFrame) -> DataFrame:
    return capped.agg(F.count_if(~F.col("is_accepted")).alias("delta")).select(
        F.lit("rejected_bindings").alias("name"), "delta"
    )


def drains(kept: DataFrame) -> DataFrame:
    return kept.agg(F.count(F.lit(1)).alias("value")).select(F.lit("drains").alias("name"), "value")


def adapters(workers: DataFrame) -> DataFrame:
    """Workers that answered in this term."""
    return workers.agg(F.count_if("healthy").alias("value")).select(F.lit("adapters").alias("name"), "value")


def bad_connections(polls: DataFrame) -> DataFrame:
    """Polls of a worker that failed; ``polls`` has one row per worker and attempt."""
    return polls.agg(F.count_if(~F.col("healthy")).alias("delta")).select(
        F.lit("bad_adapter_connections").alias("name"), "delta"
    )


def drain_health(validated: DataFrame) -> DataFrame:
    """Kept and removed bindings of a term, in one pass."""
    removed = F.col("reject_reason").isNotNull()
    return validated.agg(
        F.count_if(~removed).alias("drainCount"),
        F.count_if(removed).alias("blacklistedOrInvalidUrlCount"),
    )


def worker_health(workers: DataFrame) -> DataFrame:
    """Configured workers, whether they answer or not."""
    return workers.agg(F.count_distinct("worker").alias("adapterCount"))


def health_counters(*snapshots: DataFrame) -> DataFrame:
    """One-row snapshots as rows of ``seq``, ``name`` and ``count``, in the order given."""
    rows = None
    for seq, snapshot in enumerate(snapshots):
        named = F.create_map(
            *[c for name in snapshot.columns for c in (F.lit(name), F.col(f"`{name}`").cast("long"))]
        )
        part = snapshot.select(F.lit(seq).cast("long").alias("seq"), F.explode(named).alias("name", "count"))
        rows = part if rows is None else rows.unionByName(part)
    return rows


def health_json(counters: DataFrame) -> DataFrame:
    """Counters merged by name, the last one set being kept, as one JSON object."""
    merged = counters.groupBy("name").agg(F.max_by("count", "seq").alias("count"))
    entries = F.array_sort(F.collect_list(F.struct("name", "count")))
    return merged.agg(F.to_json(F.map_from_entries(entries)).alias("health"))


def pulse(counters: DataFrame, gauges: DataFrame, interval: str = "1 minute") -> DataFrame:
    """What is emitted each interval: sums of counter deltas and the last value of gauges.

    ``counters``: ``ts``, ``name``, ``delta``. ``gauges``: ``ts``, ``name``, ``value``.
    """
    window = F.window("ts", interval)
    sums = counters.groupBy(window, "name").agg(F.sum("delta").cast("double").alias("value"))
    last = gauges.groupBy(window, "name").agg(F.max_by("value", "ts").cast("double").alias("value"))
    return sums.withColumn("metric", F.lit("counter")).unionByName(
        last.withColumn("metric", F.lit("gauge"))
    ).select(F.col("window.start").alias("start"), "name", "metric", "value")


def pulse_counters(counters: DataFrame, interval: str = "1 minute") -> DataFrame:
    """The counter half of ``pulse``, usable on a stream with a watermark on ``ts``."""
    return (
        counters.groupBy(F.window("ts", interval), "name")
        .agg(F.sum("delta").alias("delta"))
        .select(F.col("window.start").alias("start"), "name", "delta")
    )
