"""Queries on envelopes: joining with bindings, rendering, buffering, counting."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outfall.functions import rfc5424
from outfall.operators import metrics, routing, selflogs
from outfall.operators.buffer import is_buffered, lost_messages, with_buffer_edges
from outfall.operators.selectors import with_kinds
from outfall.plans import oracle_views as sql
from outfall.plans import views
from outfall.plans.registry import query
from outfall.schema import BINDING_KEY
from outfall.sources.envelopes import parse_batches
from outfall.streaming.delivery import backoff_wait_ms

#: Buffer of the overrun queries; an app has more envelopes than that.
_BUFFER = 40
_REPLICAS = 2

def _selected(spark: SparkSession, sf_dir: str, metrics_enabled: bool = True) -> DataFrame:
    return with_kinds(views.bindings(spark, sf_dir).select(*BINDING_KEY), metrics_enabled)


def _routed(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    ready = routing.prerender(views.envelopes(spark, sf_dir))
    return routing.fan_out(ready, _selected(spark, sf_dir), **options)


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.render(_routed(spark, sf_dir))


@query(f"WITH {sql.ROUTED} SELECT env_id, app_id, hostname, drain, part, frame FROM messages")
def rendered_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: every envelope of every event, as the text that each drain receives."""
    rendered = _messages(spark, sf_dir)
    return rendered.select("env_id", *BINDING_KEY, F.col("part").cast("long").alias("part"), "frame")


@query(
    f"""WITH {sql.ENV}
SELECT env_id, source_id, instance_id, timestamp_ns, kind, CASE WHEN kind = 'log' THEN payload END AS payload,
  CASE WHEN kind = 'counter' THEN CAST(total AS BIGINT) END AS total FROM env"""
)
def src2_batch_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes in JSON batches of a hundred, and out of them again."""
    every = views.envelopes(spark, sf_dir)
    batches = (
        every.groupBy(F.floor(F.col("env_id") / 100).alias("n"))
        .agg(F.collect_list(F.struct(*every.columns)).alias("batch"))
        .select(F.to_json(F.struct("batch")).alias("value"))
    )
    return parse_batches(batches).select(
        "env_id",
        "source_id",
        "instance_id",
        "timestamp_ns",
        "kind",
        F.col("log.payload").cast("string").alias("payload"),
        F.col("counter.total").cast("long").alias("total"),
    )


@query(
    """SELECT conv_id, turn, role, text FROM conversations"""
)
def src2_conversation_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns in batches of sixteen at most, flattened."""
    turns = views.table(spark, sf_dir, "conversations")
    batches = turns.groupBy("conv_id", F.floor(F.col("turn") / 16).alias("n")).agg(
        F.collect_list(F.struct("turn", "role", "text")).alias("batch")
    )
    return batches.select("conv_id", F.explode("batch").alias("e")).select("conv_id", "e.*")


def _strays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes as the streams of their apps gave them; every seventh is another app's."""
    app = F.concat(
        F.lit("app-"), (F.col("user_id") + F.when(F.col("event_id") % 7 == 0, 1).otherwise(0)).cast("string")
    )
    events = views.table(spark, sf_dir, "events").select(F.col("event_id").alias("env_id"), app.alias("app_id"))
    return views.envelopes(spark, sf_dir).join(events, "env_id")


@query("SELECT event_id AS env_id, 'app-' || user_id AS app_id FROM events WHERE event_id % 7 <> 0")
def flt4_own_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.own_envelopes(_strays(spark, sf_dir)).select("env_id", "app_id")


@query("SELECT 'ingress' AS name, count(*) AS delta FROM events")
def agg1_ingress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counted before the guard, so strays are in it."""
    return metrics.ingress(_strays(spark, sf_dir))


@query(
    f"""WITH {sql.SELECTED}, {sql.ENV}
SELECT drain_type, kind, count(*) AS envelopes FROM env e
JOIN selected b ON b.app_id = e.source_id AND list_contains(b.kinds, e.kind) GROUP BY drain_type, kind"""
)
def flt5_kinds_by_drain_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = routing.fan_out(
        views.envelopes(spark, sf_dir).select("env_id", "source_id", "kind"), _selected(spark, sf_dir)
    )
    wanted = F.regexp_extract("drain", "drain-type=(.*)$", 1)
    return pairs.groupBy(wanted.alias("drain_type"), "kind").agg(F.count(F.lit(1)).alias("envelopes"))


@query(f"WITH {sql.PARTS} SELECT kind, count(*) AS messages FROM parts GROUP BY kind")
def flt6_rendered_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready = routing.prerender(views.envelopes(spark, sf_dir))
    return ready.groupBy("kind").agg(F.count_if("has_message").alias("messages"))


@query(f"WITH {sql.ROUTED} SELECT env_id, app_id, hostname, drain, part, is_valid FROM messages")
def flt7_message_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    rendered = _messages(spark, sf_dir)
    return rendered.select("env_id", *BINDING_KEY, F.col("part").cast("long").alias("part"), "is_valid")


_PAIRS = f"""WITH {sql.SELECTED}, {sql.ENV}
SELECT env_id, kind, b.app_id, b.hostname, b.drain FROM env e
JOIN selected b ON b.app_id = e.source_id AND list_contains(b.kinds, e.kind)"""


def _pairs(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    slim = views.envelopes(spark, sf_dir).select("env_id", "source_id", "kind")
    return routing.fan_out(slim, _selected(spark, sf_dir), **options).select("env_id", "kind", *BINDING_KEY)


@query(_PAIRS)
def join1_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir)


@query(_PAIRS)
def join1_fan_out_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The way taken when the bindings are too many to be sent to all executors."""
    return _pairs(spark, sf_dir, max_broadcast_bytes=0)


@query(
    f"""WITH {sql.SELECTED}, {sql.ENV}
SELECT env_id, b.app_id, b.hostname, b.drain FROM env e JOIN selected b ON b.app_id = e.source_id
WHERE e.kind = 'log'"""
)
def join1_fan_out_metrics_off(spark: SparkSession, sf_dir: str) -> DataFrame:
    slim = views.envelopes(spark, sf_dir).select("env_id", "source_id", "kind")
    return routing.fan_out(slim, _selected(spark, sf_dir, metrics_enabled=False)).select("env_id", *BINDING_KEY)


_BUFFERED = f"""{sql.SELECTED}, {sql.ENV},
pairs AS (SELECT env_id, e.timestamp_ns, e.kind, b.app_id, b.hostname, b.drain FROM env e
  JOIN selected b ON b.app_id = e.source_id AND list_contains(b.kinds, e.kind)),
buffered AS (SELECT *, row_number() OVER (PARTITION BY app_id, hostname, drain
    ORDER BY timestamp_ns DESC, env_id DESC) <= {_BUFFER} AS is_buffered FROM pairs),
lost AS (SELECT app_id, hostname, drain, count(*) - {_BUFFER} AS missed FROM pairs
  GROUP BY app_id, hostname, drain HAVING count(*) > {_BUFFER})"""


def _with_edges(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return with_buffer_edges(views.envelopes(spark, sf_dir), _selected(spark, sf_dir), _BUFFER, **options)


@query(f"WITH {_BUFFERED} SELECT env_id, app_id, hostname, drain, is_buffered FROM buffered")
def rank7_bounded_buffer(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready = routing.prerender(views.envelopes(spark, sf_dir)).filter(F.col("part") == 0)
    routed = routing.fan_out(ready, _with_edges(spark, sf_dir))
    return routed.select("env_id", *BINDING_KEY, is_buffered().alias("is_buffered"))


@query(
    f"""WITH {_BUFFERED}
SELECT b.env_id, b.app_id, b.hostname, b.drain, CAST(p.part AS BIGINT) AS part FROM buffered b
JOIN (SELECT env_id, unnest(CASE WHEN kind = 'gauge' THEN [0, 1] ELSE [0] END) AS part FROM env) p
  ON p.env_id = b.env_id WHERE b.is_buffered"""
)
def rank7_buffered_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All parts of an envelope share its fate. Every join is by shuffle here."""
    targets = _with_edges(spark, sf_dir, max_broadcast_bytes=0)
    ready = routing.prerender(views.envelopes(spark, sf_dir))
    kept = routing.fan_out(ready, targets, max_broadcast_bytes=0).filter(is_buffered())
    return kept.select("env_id", *BINDING_KEY, F.col("part").cast("long").alias("part"))


def _lost(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lost_messages(_with_edges(spark, sf_dir), _BUFFER)


@query(f"WITH {_BUFFERED} SELECT 'dropped' AS name, CAST(sum(missed) AS BIGINT) AS delta FROM lost")
def agg3_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.dropped(_lost(spark, sf_dir))


@query(
    f"""WITH {_BUFFERED}
SELECT app_id AS source_id, e.source_type AS source_type, e.instance_id AS instance_id, payload FROM (
  SELECT app_id, missed || ' messages lost in user provided syslog drain' AS payload,
    unnest([{{'source_type': 'LGR', 'instance_id': ''}}, {{'source_type': 'SYS', 'instance_id': '3'}}]) AS e FROM lost)"""
)
def log6_lost_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selflogs.lost_message_logs(_lost(spark, sf_dir), "3")


@query(
    f"""SELECT event_id AS env_id,
  CAST('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8) AS BIGINT) % {_REPLICAS} AS replica FROM events"""
)
def rank8_replica_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.envelopes(spark, sf_dir).select(
        "env_id", routing.replica(F.col("env_id"), _REPLICAS).alias("replica")
    )


@query(
    f"""WITH {sql.ENV}, {sql.SELECTED}, logs AS (
  SELECT custkey, app_id FROM selected WHERE NOT drain_type_ok)
SELECT env_id, source_id, kind, CASE WHEN kind = 'log' THEN payload END AS payload FROM env
UNION ALL SELECT -1 - custkey, app_id, 'log', 'Invalid drain-type' FROM logs"""
)
def set2_self_logs_among_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    selected = with_kinds(views.bindings(spark, sf_dir), True)
    invalid = selected.filter(~F.col("drain_type_ok"))
    logs = selflogs.as_envelopes(
        invalid.select(
            F.col("app_id").alias("source_id"),
            F.lit("SYS").alias("source_type"),
            F.lit("3").alias("instance_id"),
            F.lit(selflogs.INVALID_DRAIN_TYPE).alias("payload"),
            "custkey",
        ),
        F.lit(0),
        -1 - F.col("custkey"),
    )
    together = selflogs.with_self_logs(views.envelopes(spark, sf_dir), logs)
    return together.select("env_id", "source_id", "kind", F.col("log.payload").cast("string").alias("payload"))


def _logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.envelopes(spark, sf_dir).filter(F.col("kind") == "log")


@query(f"WITH {sql.ENV} SELECT env_id, CAST(log_priority AS BIGINT) AS priority FROM env WHERE kind = 'log'")
def rfc1_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _logs(spark, sf_dir).select(
        "env_id", rfc5424.priority(F.col("log.type")).cast("long").alias("priority")
    )


@query(f"WITH {sql.ENV} SELECT env_id, {sql.LOG_PROCESS} AS procid FROM env WHERE kind = 'log'")
def rfc2_log_process_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    process = rfc5424.log_process_id(F.col("tags")["source_type"], F.col("instance_id"))
    return _logs(spark, sf_dir).select("env_id", process.alias("procid"))


@query(f"WITH {sql.ENV} SELECT env_id, '[' || instance_id || ']' AS procid FROM env WHERE kind IN ('gauge', 'counter')")
def rfc3_metric_process_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.envelopes(spark, sf_dir).filter(F.col("kind").isin("gauge", "counter"))
    return rows.select("env_id", rfc5424.metric_process_id(F.col("instance_id")).alias("procid"))


_DOCUMENTS = """docs AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN chr(0) ELSE '' END || text
  || CASE WHEN doc_id % 4 = 0 THEN chr(10) ELSE '' END AS payload FROM documents),
doc_texts AS (SELECT doc_id, replace(payload, chr(0), '') AS clean, CASE
  WHEN ends_with(replace(payload, chr(0), ''), chr(10)) THEN replace(payload, chr(0), '')
  ELSE replace(payload, chr(0), '') || chr(10) END AS text FROM docs)"""


@query(f"WITH {_DOCUMENTS} SELECT doc_id, octet_length(encode(clean)) AS octets, md5(clean) AS digest FROM doc_texts")
def rfc4_null_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _digests(views.document_logs(spark, sf_dir), rfc5424.strip_nulls(F.col("log.payload")))


@query(f"WITH {_DOCUMENTS} SELECT doc_id, octet_length(encode(text)) AS octets, md5(text) AS digest FROM doc_texts")
def rfc5_final_newline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _digests(views.document_logs(spark, sf_dir), rfc5424.log_text(F.col("log.payload")))


def _digests(rows: DataFrame, text) -> DataFrame:
    return rows.select(
        F.col("env_id").alias("doc_id"),
        F.octet_length(text).cast("long").alias("octets"),
        F.md5(text.cast("binary")).alias("digest"),
    )


@query(f"WITH {sql.ENV} SELECT env_id, timestamp_ns, ts_text AS ts FROM env")
def rfc6_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = rfc5424.timestamp_text(F.col("timestamp_ns"))
    return views.envelopes(spark, sf_dir).select("env_id", "timestamp_ns", text.alias("ts"))


def _parts(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    ready = routing.prerender(views.envelopes(spark, sf_dir).filter(F.col("kind") == kind))
    text = rfc5424.message(F.col("head"), F.lit("test.space"), F.col("tail"))
    return ready.select("env_id", F.coalesce("metric", F.lit("")).alias("metric"), text.alias("message"))


def _parts_sql(kind: str) -> str:
    return f"""WITH {sql.PARTS}
SELECT env_id, coalesce(metric, '') AS metric, head || 'test.space' || tail AS message FROM heads WHERE kind = '{kind}'"""


@query(_parts_sql("log"))
def rfc7_log_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parts(spark, sf_dir, "log")


@query(_parts_sql("gauge"))
def rfc8_gauge_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parts(spark, sf_dir, "gauge")


@query(_parts_sql("counter"))
def rfc9_counter_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parts(spark, sf_dir, "counter")


@query(f"WITH {sql.ENV} SELECT env_id, {sql.READING} AS reading FROM env WHERE kind = 'gauge'")
def rfc10_float_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    gauges = views.envelopes(spark, sf_dir).filter(F.col("kind") == "gauge")
    value = F.col("gauge.metrics")["value"]["value"]
    return gauges.select("env_id", value.alias("v")).select("env_id", rfc5424.float_text(F.col("v")).alias("reading"))


@query(
    r"""SELECT doc_id, md5(replace(replace(replace(text || '"a]\', '\', '\\'), '"', '\"'), ']', '\]')) AS digest
FROM documents"""
)
def rfc11_sd_escape(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = rfc5424.escape_sd(F.concat("text", F.lit('"a]\\')))
    return views.table(spark, sf_dir, "documents").select(
        "doc_id", F.md5(text.cast("binary")).alias("digest")
    )


_DOCUMENT_MESSAGES = (
    _DOCUMENTS
    + """,
doc_messages AS (SELECT doc_id, '<14>1 ' || strftime(make_timestamp((doc_id * 1000003) // 1000), '%Y-%m-%dT%H:%M:%S.%f')
  || '+00:00 test.space app-' || (doc_id % 200) || ' [APP/' || (doc_id % 4) || '] - - ' || text AS message FROM doc_texts)"""
)


def _document_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready = routing.prerender(views.document_logs(spark, sf_dir))
    return ready.select(
        "env_id", rfc5424.message(F.col("head"), F.lit("test.space"), F.col("tail")).alias("message")
    )


@query(
    f"""WITH {_DOCUMENT_MESSAGES}, framed AS (
  SELECT doc_id, octet_length(encode(message)) || ' ' || message AS frame FROM doc_messages)
SELECT doc_id, octet_length(encode(frame)) AS octets, md5(frame) AS digest FROM framed"""
)
def rfc12_framed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _digests(_document_messages(spark, sf_dir), rfc5424.frame(F.col("message")))


@query(
    f"""WITH {sql.ROUTED} SELECT env_id, app_id, hostname, drain, part, message AS body FROM messages
WHERE scheme = 'https'"""
)
def rfc13_https_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    bodies = _messages(spark, sf_dir).filter(F.col("scheme") == "https")
    return bodies.select("env_id", *BINDING_KEY, F.col("part").cast("long").alias("part"), F.col("frame").alias("body"))


@query(
    f"""WITH {sql.ROUTED}
SELECT env_id, drain, part, CAST(priority AS BIGINT) AS priority, ts_text AS ts, hostname, app_id AS app,
  procid, '-' AS msgid, sd, text AS msg FROM messages WHERE is_valid"""
)
def rfc14_parsed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rendered, framed, then read back."""
    valid = _messages(spark, sf_dir).filter("is_valid")
    text = F.when(F.col("scheme") == "https", F.col("frame")).otherwise(rfc5424.unframe(F.col("frame")))
    fields = valid.select("env_id", "drain", "part", text.alias("t")).select(
        "env_id", "drain", F.col("part").cast("long").alias("part"), rfc5424.parse(F.col("t")).alias("m")
    )
    return fields.select(
        "env_id",
        "drain",
        "part",
        F.col("m.priority").cast("long").alias("priority"),
        *[f"m.{c}" for c in ("ts", "hostname", "app", "procid", "msgid", "sd", "msg")],
    )


@query(
    """SELECT event_id AS env_id, CAST(sum(CASE WHEN n = 0 THEN 1 ELSE least(power(2, n - 1), 15000) END) AS BIGINT) AS wait_ms
FROM (SELECT event_id, unnest(range(0, event_id % 22 + 1)) AS n FROM events) GROUP BY event_id"""
)
def snk6_backoff_waits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an envelope waits in all, if its first n + 1 tries fail."""
    tries = views.envelopes(spark, sf_dir).select(
        "env_id", F.explode(F.sequence(F.lit(0), F.col("env_id") % 22)).alias("n")
    )
    return tries.groupBy("env_id").agg(F.sum(backoff_wait_ms(F.col("n"))).alias("wait_ms"))


@query(
    """SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS "start", event_type AS name, 'counter' AS metric,
  CAST(count(*) AS DOUBLE) AS value FROM events GROUP BY 1, 2
UNION ALL
SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S'), 'level', 'gauge', arg_max(value, ts) FROM events GROUP BY 1"""
)
def agg10_pulse(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = views.table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    pulses = metrics.pulse(
        events.select("ts", F.col("event_type").alias("name"), F.lit(1).alias("delta")),
        events.select("ts", F.lit("level").alias("name"), "value"),
        "1 hour",
    )
    return pulses.withColumn("start", F.date_format("start", "yyyy-MM-dd HH:mm:ss"))
