"""Queries that run streams or sinks to the end and return what they have written."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outfall.operators import metrics, placement, routing
from outfall.plans import oracle_views as sql
from outfall.plans import views
from outfall.plans.queries_messages import _BUFFER, _BUFFERED, _messages
from outfall.plans.registry import query
from outfall.schema import BINDING_KEY, ENVELOPE
from outfall.session import settle, shared_dir
from outfall.sources import versions
from outfall.sources.envelopes import stream_envelopes
from outfall.streaming import delivery, fanout
from outfall.streaming.sinks import TableWriter, Target, with_retry

_ALL_MESSAGES = f"WITH {sql.ROUTED} SELECT env_id, app_id, hostname, drain, part, frame FROM messages"


#: Envelopes in a file that a stream reads, if there are more than four of them.
_FILE_ENVELOPES = 100_000


def _files(spark: SparkSession, sf_dir: str) -> int:
    """How many files a stream reads in all: a multiple of four, so that its tasks do not grow with the input."""
    return 4 * max(1, -(-views.table(spark, sf_dir, "events").count() // (4 * _FILE_ENVELOPES)))


def _landed(spark: SparkSession, sf_dir: str, remainder: int | None = None, path: str | None = None) -> str:
    """Envelopes as files that a stream can read: all, or every other one, added to ``path``."""
    path = path or shared_dir(spark)
    every = views.envelopes(spark, sf_dir)
    part = every if remainder is None else every.filter(F.col("env_id") % 2 == remainder)
    part.repartition(_files(spark, sf_dir), "env_id").write.mode("append").parquet(path)
    return path


def _landed_heat(spark: SparkSession, path: str, batches: int = 1) -> DataFrame:
    """Envelopes that apps have landed, for each of so many micro-batches."""
    return fanout.earlier_heat(spark.read.schema(ENVELOPE).parquet(path), batches)


def _read(messages: DataFrame) -> DataFrame:
    return messages.select("env_id", *BINDING_KEY, F.col("part").cast("long").alias("part"), "frame")


@query(f"WITH {sql.ENV} SELECT env_id, source_id, kind, timestamp_ns FROM env")
def src1_envelope_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = stream_envelopes(spark, _landed(spark, sf_dir), maxFilesPerTrigger=str(_files(spark, sf_dir) // 2))
    out = shared_dir(spark)
    running = (
        stream.select("env_id", "source_id", "kind", "timestamp_ns")
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", shared_dir(spark))
        .trigger(availableNow=True)
        .start()
    )
    fanout.finish(running)
    return spark.read.parquet(out)


@query(_ALL_MESSAGES)
def str1_stateless_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed, half = _landed(spark, sf_dir), _files(spark, sf_dir) // 2
    stream = stream_envelopes(spark, landed, maxFilesPerTrigger=str(half))
    out = shared_dir(spark)
    bindings = views.bindings(spark, sf_dir).select(*BINDING_KEY)
    fanout.finish(fanout.start_stateless(stream, bindings, out, shared_dir(spark), heat=_landed_heat(spark, landed, 2)))
    return _read(spark.read.parquet(out))


@query(
    f"""WITH {sql.ROUTED}
SELECT env_id, app_id, hostname, drain, part, frame FROM messages WHERE env_id % 2 = 1 OR custkey % 3 <> 0"""
)
def str2_changing_drain_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the envelopes with two thirds of the bindings, the other half with all of them."""
    every = views.bindings(spark, sf_dir)
    table, out, checkpoint = shared_dir(spark), shared_dir(spark), shared_dir(spark)
    current = fanout.binding_files(spark, table)
    path = None
    for remainder, bindings in ((0, every.filter(F.col("custkey") % 3 != 0)), (1, every)):
        versions.publish(bindings.select(*BINDING_KEY), table)
        path = _landed(spark, sf_dir, remainder, path)
        running = fanout.start_fan_out(stream_envelopes(spark, path), current, out, checkpoint)
        fanout.finish(running)
    return _read(spark.read.parquet(f"{out}/messages"))


def _buffered_stream(spark: SparkSession, sf_dir: str) -> str:
    out = shared_dir(spark)
    stream = stream_envelopes(spark, _landed(spark, sf_dir))
    bindings = views.bindings(spark, sf_dir).select(*BINDING_KEY)
    running = fanout.start_fan_out(
        stream, lambda: bindings, out, shared_dir(spark), capacity=_BUFFER, worker_index="3"
    )
    fanout.finish(running)
    return out


@query(f"WITH {_BUFFERED} SELECT app_id, hostname, drain, missed FROM lost")
def str3_buffer_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _buffered_stream(spark, sf_dir)
    return spark.read.parquet(f"{out}/lost").select(*BINDING_KEY, "missed")


@query(
    f"""WITH {sql.ROUTED}
SELECT 'w' || CAST('0x' || substr(md5(CAST(env_id AS VARCHAR)), 1, 8) AS BIGINT) % 2 AS worker,
  env_id, app_id, hostname, drain, part, frame FROM messages"""
)
def rank8_two_workers_share_a_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every binding is placed on two workers, whose fan-outs send each message once between them."""
    bindings = views.bindings(spark, sf_dir).select(*BINDING_KEY).dropDuplicates()
    pool = spark.createDataFrame([("w0",), ("w1",)], "worker string")
    assignment, landed, sent = settle(placement.place(bindings, pool)), _landed(spark, sf_dir), []
    for worker in ("w0", "w1"):
        out, share = shared_dir(spark), routing.shares(assignment, worker)
        running = fanout.start_fan_out(stream_envelopes(spark, landed), lambda share=share: share, out, shared_dir(spark))
        fanout.finish(running)
        sent.append(_read(spark.read.parquet(f"{out}/messages")).withColumn("worker", F.lit(worker)))
    return sent[0].unionByName(sent[1])


@query(
    f"""WITH {sql.SELECTED},
logs AS (SELECT app_id AS source_id FROM selected WHERE NOT drain_type_ok),
echoes AS (SELECT b.app_id, b.hostname, b.drain, b.scheme_text AS scheme, '<11>1 2024-01-01T00:00:00.000000+00:00 '
    || b.hostname || ' ' || b.app_id || ' [SYS/3] - - Invalid drain-type' || chr(10) AS message
  FROM logs l JOIN selected b ON b.app_id = l.source_id AND list_contains(b.kinds, 'log'))
SELECT app_id, hostname, drain, CASE WHEN scheme = 'https' THEN message
  ELSE octet_length(encode(message)) || ' ' || message END AS frame FROM echoes"""
)
def set2_self_logs_through_the_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Complaints about drain types come back as envelopes and go to all drains of the app that take logs, once."""
    out, checkpoint, feedback, landed = (shared_dir(spark) for _ in range(4))
    bindings = views.bindings(spark, sf_dir).select(*BINDING_KEY)
    envelopes = views.envelopes(spark, sf_dir, is_spread=False)
    envelopes.filter("env_id < 0").write.parquet(landed)
    for part in (0, 1, 2):
        # One more envelope, for an app without drains, makes sure that there is a micro-batch.
        envelopes.limit(1).withColumn("source_id", F.lit(f"nobody-{part}")).write.mode("append").parquet(landed)
        running = fanout.start_fan_out(
            stream_envelopes(spark, landed), lambda: bindings, out, checkpoint, worker_index="3", feedback=feedback,
            now_ns=F.lit(1_704_067_200_000_000_000),
        )
        fanout.finish(running)
    return spark.read.parquet(f"{out}/messages").select(*BINDING_KEY, "frame")


@query(
    f"""WITH {sql.ROUTED},
{_BUFFERED.removeprefix(f'{sql.SELECTED}, {sql.ENV},')},
routed_once AS (SELECT DISTINCT e.env_id, b.custkey FROM env e
  JOIN selected b ON b.app_id = e.source_id AND list_contains(b.kinds, e.kind)),
counts AS (
  SELECT 'dropped' AS name, CAST(sum(missed) AS DOUBLE) AS value FROM lost
  UNION ALL SELECT 'ingress', count(*) FROM routed_once
  UNION ALL SELECT 'drain_bindings', count(*) FROM selected
  UNION ALL SELECT 'egress.' || m.scheme, count(*) FROM messages m JOIN buffered b ON b.env_id = m.env_id
    AND b.app_id = m.app_id AND b.hostname = m.hostname AND b.drain = m.drain
  WHERE b.is_buffered AND m.is_valid AND m.scheme IN ('syslog', 'https') GROUP BY m.scheme)
SELECT '2024-01-01 00:00:00' AS "start", name, CASE WHEN name = 'drain_bindings' THEN 'gauge' ELSE 'counter' END AS metric,
  value FROM counts"""
)
def agg10_pulse_of_a_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a stream has counted equals the counts of what it has written: received, lost, sent and served."""
    out = shared_dir(spark)
    bindings = views.bindings(spark, sf_dir).select(*BINDING_KEY)
    running = fanout.start_fan_out(
        stream_envelopes(spark, _landed(spark, sf_dir)), lambda: bindings, out, shared_dir(spark), capacity=_BUFFER,
        sinks=dict.fromkeys(("syslog", "https"), TableWriter), now_ns=F.lit(1_704_067_200_000_000_000),
    )
    fanout.finish(running)
    pulse = metrics.pulse_of(fanout.read_metrics(spark, out))
    return pulse.withColumn("start", F.date_format("start", "yyyy-MM-dd HH:mm:ss"))


@query(_ALL_MESSAGES)
def str4_restarted_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run to the end, stopped, and started again from its checkpoint when more has come."""
    out, checkpoint = shared_dir(spark), shared_dir(spark)
    bindings = views.bindings(spark, sf_dir).select(*BINDING_KEY)
    path = None
    for remainder in (0, 1):
        path = _landed(spark, sf_dir, remainder, path)
        heat = _landed_heat(spark, path)
        fanout.finish(fanout.start_stateless(stream_envelopes(spark, path), bindings, out, checkpoint, heat=heat))
    return _read(spark.read.parquet(out))


@query(
    """SELECT strftime("start", '%Y-%m-%d %H:%M:%S') AS "start", name, delta FROM (
  SELECT date_trunc('hour', ts) AS "start", event_type AS name, count(*) AS delta FROM events GROUP BY 1, 2)
WHERE "start" + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events)"""
)
def str5_pulse_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours that are over; the last one stays open."""
    events = views.table(spark, sf_dir, "events").select(
        F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("name"), F.lit(1).alias("delta")
    )
    path, out = shared_dir(spark), shared_dir(spark)
    events.write.parquet(path)
    stream = spark.readStream.schema(events.schema).parquet(path)
    fanout.finish(fanout.start_pulse(stream, out, shared_dir(spark), "1 hour"))
    return spark.read.parquet(out).withColumn("start", F.date_format("start", "yyyy-MM-dd HH:mm:ss"))


@query(
    f"""WITH {sql.ROUTED}
SELECT is_valid, scheme, count(*) AS messages, CAST(sum(octet_length(encode(frame))) AS BIGINT) AS octets
FROM messages GROUP BY is_valid, scheme"""
)
def snk1_files_by_scheme(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shared_dir(spark)
    delivery.write_messages(_messages(spark, sf_dir), out)
    written = delivery.read_messages(spark, out)
    return written.groupBy("is_valid", "scheme").agg(
        F.count(F.lit(1)).alias("messages"), F.sum(F.octet_length("frame")).alias("octets")
    )


@query(
    f"""WITH {sql.ROUTED}
SELECT message FROM messages WHERE is_valid AND scheme IN ('syslog', 'syslog-tls')"""
)
def rfc15_deframed_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames written as one byte stream per drain, and taken apart again."""
    out = shared_dir(spark)
    framed = _messages(spark, sf_dir).filter(F.col("scheme").isin("syslog", "syslog-tls"))
    delivery.write_captures(framed, out)
    return delivery.read_captures(spark, out).select(F.col("message").cast("string").alias("message"))


#: Messages from which on a drain is sorted by ranges in the query on order: some drains are over it.
_BUSY = 60
#: Tries for one envelope in the queries on delivery.
_TRIES = 4


class RefusingWriter(TableWriter):
    """Takes the first message of an envelope and then breaks off, as often as the message's md5 says.

    The first hex digit decides: up to 7 never, up to b once, c and d twice, e three times, f always.
    """

    def __init__(self, target: Target):
        super().__init__(target)
        self._tried: dict[bytes, int] = {}

    def write(self, messages: list[bytes]) -> None:
        digest = hashlib.md5(messages[0]).digest()
        refusals = (0, 0, 0, 0, 0, 0, 0, 0, 1, 1, 1, 1, 2, 2, 3, 10**9)[digest[0] >> 4]
        tried = self._tried.pop(digest, 0)
        if tried < refusals:
            self._tried = {digest: tried + 1}
            super().write(messages[:1])
            raise OSError("the drain broke off")
        super().write(messages)


def _outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries to drains that break off now and then; there is no sink for plain http."""
    sink = with_retry(RefusingWriter, tries=_TRIES)
    return delivery.deliver(_messages(spark, sf_dir), dict.fromkeys(("syslog", "syslog-tls", "https"), sink), shared_dir(spark))


_OUTCOMES = f"""{sql.ROUTED},
grouped AS (SELECT env_id, app_id, hostname, drain, scheme, count(*) AS messages, bool_and(is_valid) AS is_valid,
    sum(octet_length(encode(frame))) AS octets, min_by(octet_length(encode(frame)), part) AS first_octets,
    min_by(md5(frame), part) AS digest
  FROM messages GROUP BY env_id, app_id, hostname, drain, scheme),
refused AS (SELECT *, CASE WHEN left(digest, 1) < '8' THEN 0 WHEN left(digest, 1) < 'c' THEN 1
    WHEN left(digest, 1) < 'e' THEN 2 WHEN left(digest, 1) = 'e' THEN 3 ELSE {_TRIES} END AS refusals FROM grouped),
outcomes AS (SELECT *, CASE WHEN scheme NOT IN ('syslog', 'syslog-tls', 'https') THEN 'unsupported protocol'
    WHEN NOT is_valid THEN 'message is not valid' WHEN refusals >= {_TRIES} THEN 'the drain broke off' END AS error,
    scheme IN ('syslog', 'syslog-tls', 'https') AND is_valid AS is_tried
  FROM refused)"""

_SENT = f"CASE WHEN is_tried THEN refusals + CASE WHEN refusals < {_TRIES} THEN messages ELSE 0 END ELSE 0 END"


@query(
    f"""WITH {_OUTCOMES}
SELECT env_id, app_id, hostname, drain, scheme, messages, {_SENT} AS sent,
  CASE WHEN is_tried THEN least(refusals + 1, {_TRIES}) ELSE 0 END AS attempts, error IS NULL AS delivered, error,
  {_SENT} AS received,
  CAST(CASE WHEN is_tried THEN refusals * first_octets + CASE WHEN refusals < {_TRIES} THEN octets ELSE 0 END ELSE 0 END
    AS BIGINT) AS received_octets
FROM outcomes"""
)
def snk5_delivery_with_retries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes, next to what the drains have got: every retry begins with the first message again."""
    outcomes = _outcomes(spark, sf_dir)
    numbers = [F.col(c).cast("long").alias(c) for c in ("messages", "sent", "attempts")]
    got = F.coalesce("received", F.array().cast("array<binary>"))
    octets = F.aggregate(got, F.lit(0).cast("long"), lambda total, m: total + F.octet_length(m))
    return outcomes.select(
        "env_id", *BINDING_KEY, "scheme", *numbers, "delivered", "error",
        F.size(got).cast("long").alias("received"), octets.alias("received_octets"),
    )


@query(
    f"""WITH {_OUTCOMES}
SELECT env_id, app_id, hostname, drain, error FROM outcomes WHERE error IS NOT NULL"""
)
def snk4_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unknown schemes, and what was given up after all tries."""
    return delivery.dead_letters(_outcomes(spark, sf_dir)).select("env_id", *BINDING_KEY, "error")


@query(
    f"""WITH {sql.ROUTED} SELECT env_id, app_id, hostname, drain, part, frame FROM messages"""
)
def snk7_first_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All messages once, and those of every third envelope once more, as a retry sends them."""
    sent = _messages(spark, sf_dir)
    received = sent.unionByName(sent.filter(F.col("env_id") % 3 == 0))
    return _read(delivery.first_deliveries(received))


@query(
    f"""WITH {_BUFFERED}
SELECT b.env_id, b.app_id, b.hostname, b.drain FROM buffered b WHERE b.is_buffered"""
)
def snk9_drained_buffers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All that was buffered when the stream ended has been written."""
    out = _buffered_stream(spark, sf_dir)
    written = spark.read.parquet(f"{out}/messages")
    return written.filter(F.col("part") == 0).select("env_id", *BINDING_KEY)


@query(
    f"""WITH {sql.ROUTED}
SELECT app_id, hostname, drain, env_id, part, row_number() OVER (PARTITION BY app_id, hostname, drain
  ORDER BY timestamp_ns, env_id, part) - 1 AS place FROM messages"""
)
def ord1_drain_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of each message among those of its drain, as the task that sends them meets it; some drains are busy."""
    ordered = delivery.in_drain_order(_messages(spark, sf_dir), busy=_BUSY)
    return delivery.with_places(ordered).select(*BINDING_KEY, "env_id", F.col("part").cast("long").alias("part"), "place")


@query(
    f"""WITH {_OUTCOMES}
SELECT 'egress' AS name, scheme, CAST(sum({_SENT}) AS BIGINT) AS delta FROM outcomes WHERE {_SENT} > 0 GROUP BY scheme"""
)
def agg2_egress(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.egress(_outcomes(spark, sf_dir))

