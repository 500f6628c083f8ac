"""Queries on the drain table: reading, parsing, checking, comparing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outfall.functions import urls
from outfall.operators import metrics, selflogs, validation
from outfall.operators.bindings import distinct_bindings, remove_bindings, snapshot_diff
from outfall.operators.selectors import shard_id, with_kinds
from outfall.plans import oracle_views as sql
from outfall.plans import views
from outfall.plans.registry import query
from outfall.schema import BINDING_KEY
from outfall.sources import drain_table as source


@query(
    f"""WITH {sql.LANDED}
SELECT page * 400 AS requested_id, CAST(200 AS INTEGER) AS status,
  CASE WHEN page < (SELECT max(page) FROM paged) THEN (page + 1) * 400 ELSE 0 END AS next_id,
  count(*) AS apps, CAST(NULL AS VARCHAR) AS problem
FROM paged GROUP BY page"""
)
def src3_landed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = source.parse_pages(views.landed_pages(spark, sf_dir))
    return pages.select(
        "requested_id", "status", "next_id", F.size("results").cast("long").alias("apps"), "problem"
    )


@query(
    f"""WITH {sql.LANDED}
SELECT count(*) AS pages, count_if(page = 0) AS first_pages,
  count_if(page = (SELECT max(page) FROM paged)) AS last_pages
FROM (SELECT DISTINCT page FROM paged)"""
)
def src4_page_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = source.parse_pages(views.landed_pages(spark, sf_dir))
    source.check_pages(pages)
    return pages.agg(
        F.count(F.lit(1)).alias("pages"),
        F.count_if(F.col("requested_id") == 0).alias("first_pages"),
        F.count_if(F.col("next_id") == 0).alias("last_pages"),
    )


@query(
    f"""WITH {sql.LANDED}
SELECT app_id, hostname, unnest(drains) AS drain FROM paged"""
)
def src5_page_bindings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source.fetch_bindings(views.landed_pages(spark, sf_dir))


@query(
    """SELECT 'start-' || s_suppkey AS name,
  '10.' || s_nationkey || '.' || (s_suppkey % 200) || '.5' AS "start",
  '10.' || s_nationkey || '.' || (s_suppkey % 200 + 1) || '.0' AS "end",
  '00000000000000000000FFFF' || printf('%02X%02X%02X%02X', 10, s_nationkey, s_suppkey % 200, 5) AS start16,
  '00000000000000000000FFFF' || printf('%02X%02X%02X%02X', 10, s_nationkey, s_suppkey % 200 + 1, 0) AS end16
FROM supplier
UNION ALL
SELECT 'start-' || s_suppkey, '2001:db8::' || (s_suppkey % 10), '2001:db8::ffff:' || (s_suppkey % 10),
  '20010DB800000000000000000000000' || (s_suppkey % 10), '20010DB80000000000000000FFFF000' || (s_suppkey % 10)
FROM supplier"""
)
def src6_blocked_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, nation = F.col("s_suppkey"), F.col("s_nationkey").cast("string")
    block, next_block = (key % 200).cast("string"), (key % 200 + 1).cast("string")
    digit = (key % 10).cast("string")
    v4 = F.concat(
        F.lit("10."), nation, F.lit("."), block, F.lit(".5-10."), nation, F.lit("."), next_block, F.lit(".0")
    )
    v6 = F.concat(F.lit("2001:db8::"), digit, F.lit("-2001:db8::ffff:"), digit)
    texts = views.table(spark, sf_dir, "supplier").select(key, F.concat_ws(",", v4, v6).alias("ranges"))
    return source.parse_ranges(texts, keep=["s_suppkey"]).select(
        F.concat(F.lit("start-"), F.col("s_suppkey").cast("string")).alias("name"),
        "start",
        "end",
        F.hex("start16").alias("start16"),
        F.hex("end16").alias("end16"),
    )


@query(
    """SELECT DISTINCT '10.0.0.' || (h % 40) || ':4443' AS worker
FROM (SELECT s_suppkey % 50 AS h FROM supplier)"""
)
def src7_worker_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.col("s_suppkey") % 50
    hosts = (
        views.table(spark, sf_dir, "supplier")
        .select(F.concat(F.lit("worker-"), number.cast("string")).alias("host"), number.alias("n"))
        .dropDuplicates()
    )
    dns = hosts.select("host", F.concat(F.lit("10.0.0."), (F.col("n") % 40).cast("string")).alias("ip"))
    return source.worker_addresses(hosts.select("host"), dns, "4443")


def _all_drains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        views.bindings(spark, sf_dir)
        .select(*BINDING_KEY)
        .unionByName(views.page_bindings(spark, sf_dir))
    )


_ALL_DRAINS = f"""{sql.BIND},
all_drains AS (SELECT app_id, hostname, drain FROM bind
  UNION ALL SELECT 'app-' || (page_id % 200), 'pages.space', url FROM pages),
all_parsed AS (SELECT *, regexp_matches(drain, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]') AS parse_ok,
  lower(regexp_extract(drain, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1)) AS scheme_text,
  regexp_extract(drain, '://(?:[^/?#]*@)?([^/?#:]*)', 1) AS host_text FROM all_drains)"""


@query(
    f"""WITH {_ALL_DRAINS}
SELECT drain, parse_ok, CASE WHEN parse_ok THEN scheme_text END AS scheme,
  CASE WHEN parse_ok THEN host_text END AS host FROM all_parsed"""
)
def prj1_drain_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = validation.parse_drains(_all_drains(spark, sf_dir))
    return parsed.select("drain", "parse_ok", "scheme", "host")


@query(
    f"""WITH {sql.PARSED}
SELECT drain, host_port_text AS host_port, regexp_extract(drain, '://([^/?#:@]*):[^/?#]*@', 1) AS username,
  regexp_extract(drain, '\\?(.*)$', 1) AS query FROM parsed WHERE parse_ok"""
)
def prj2_egress_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = validation.parse_drains(views.bindings(spark, sf_dir).select(*BINDING_KEY))
    return parsed.filter("parse_ok").select("drain", "host_port", "username", "query")


@query(f"WITH {sql.PARSED} SELECT drain, drain_type FROM parsed")
def prj3_drain_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.bindings(spark, sf_dir).select("drain", urls.drain_type(F.col("drain")).alias("drain_type"))


def _kinds_text(spark: SparkSession, sf_dir: str, metrics_enabled: bool) -> DataFrame:
    selected = with_kinds(views.bindings(spark, sf_dir), metrics_enabled)
    return selected.select(*BINDING_KEY, F.array_join("kinds", ",").alias("kinds"), "drain_type_ok")


@query(
    f"""WITH {sql.SELECTED}
SELECT app_id, hostname, drain, array_to_string(kinds, ',') AS kinds, drain_type_ok FROM selected"""
)
def prj4_selected_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _kinds_text(spark, sf_dir, True)


@query(f"WITH {sql.BIND} SELECT app_id, hostname, drain, 'log' AS kinds, TRUE AS drain_type_ok FROM bind")
def prj4_selected_kinds_metrics_off(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _kinds_text(spark, sf_dir, False)


@query(f"WITH {sql.BIND} SELECT drain, replace(drain, 'user:pass@', '') AS anonymous FROM bind")
def prj5_anonymous_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.bindings(spark, sf_dir).select("drain", urls.anonymous(F.col("drain")).alias("anonymous"))


@query(
    f"""WITH {sql.BIND}
SELECT drain, CASE WHEN custkey % 6 = 2
  THEN replace(replace('Post ' || drain || ': user unknown', 'user', '<REDACTED>'), 'pass', '<REDACTED>')
  ELSE 'Post ' || drain || ': user unknown' END AS error FROM bind"""
)
def prj6_redacted_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    drain = F.col("drain")
    error = F.concat(F.lit("Post "), drain, F.lit(": user unknown"))
    return views.bindings(spark, sf_dir).select("drain", urls.redact(error, drain).alias("error"))


@query(f"WITH {sql.BIND} SELECT custkey, app_id || hostname || drain AS shard_id FROM bind")
def prj7_shard_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = shard_id(F.col("app_id"), F.col("hostname"), F.col("drain"))
    return views.bindings(spark, sf_dir).select("custkey", label.alias("shard_id"))


@query(
    f"""WITH {_ALL_DRAINS}
SELECT app_id, hostname, drain, scheme_text AS scheme FROM all_parsed
WHERE parse_ok AND scheme_text IN ('syslog', 'syslog-tls', 'https')"""
)
def flt1_allowed_schemes(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = validation.parse_drains(_all_drains(spark, sf_dir))
    return validation.allowed_schemes(parsed).select(*BINDING_KEY, "scheme")


def _validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.validate_bindings(
        views.bindings(spark, sf_dir), views.page_dns(spark, sf_dir), views.ranges(spark, sf_dir)
    )


@query(
    f"""WITH {sql.VALIDATED}
SELECT app_id, hostname, drain, scheme, host, ip, reject_reason FROM validated"""
)
def flt2_validation_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _validated(spark, sf_dir)


@query(f"WITH {sql.VALIDATED} SELECT count_if(reject_reason IS NOT NULL) AS removed FROM validated")
def flt3_removed_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.removed_count(_validated(spark, sf_dir))


def _validated_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.validate_bindings(
        views.page_bindings(spark, sf_dir), views.page_dns(spark, sf_dir), views.ranges(spark, sf_dir)
    )


_VALIDATED_PAGES = f"""{sql.PAGE_HOSTS}, {sql.RANGES},
page_checked AS (
  SELECT 'app-' || (page_id % 200) AS app_id, h.host, d.ip,
    lower(regexp_extract(url, '^([A-Za-z]+)://', 1)) AS scheme, d.host AS found,
    EXISTS (SELECT 1 FROM ranges r WHERE
      CAST(split_part(d.ip, '.', 1) AS BIGINT) * 16777216 + CAST(split_part(d.ip, '.', 2) AS BIGINT) * 65536
      + CAST(split_part(d.ip, '.', 3) AS BIGINT) * 256 + CAST(split_part(d.ip, '.', 4) AS BIGINT)
      BETWEEN r.lo AND r.hi) AS is_blocked
  FROM pages p JOIN page_hosts h ON h.host = regexp_extract(p.url, '^[a-z]+://([^/?#:]*)', 1)
  LEFT JOIN page_dns d ON d.host = h.host)"""


@query(
    f"""WITH {sql.PAGE_HOSTS}
SELECT h.host, d.ip FROM page_hosts h LEFT JOIN page_dns d ON d.host = h.host"""
)
def join2_host_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    hosts = validation.parse_drains(views.page_bindings(spark, sf_dir))
    return validation.resolve_hosts(hosts, views.page_dns(spark, sf_dir)).select("host", "ip")


@query(f"WITH {sql.VALIDATED} SELECT DISTINCT host FROM validated WHERE reject_reason = 'blocked'")
def join3_blocked_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = validation.allowed_schemes(validation.parse_drains(views.bindings(spark, sf_dir)))
    resolved = validation.resolve_hosts(parsed, views.page_dns(spark, sf_dir))
    return validation.blocked_hosts(resolved, views.ranges(spark, sf_dir))


def _held_and_desired(spark: SparkSession, sf_dir: str, renamed: bool) -> tuple[DataFrame, DataFrame]:
    every = views.bindings(spark, sf_dir)
    third = F.col("custkey") % 5
    desired = every.filter(third != 0)
    if renamed:
        new_name = F.when(F.col("custkey") % 50 == 1, "renamed.space").otherwise(F.col("hostname"))
        desired = desired.withColumn("hostname", new_name)
    return every.filter(third != 4), desired


_HELD_DESIRED = f"""{sql.BIND},
held AS (SELECT DISTINCT app_id, hostname, drain FROM bind WHERE custkey % 5 <> 4),
desired AS (SELECT DISTINCT app_id, hostname, drain FROM bind WHERE custkey % 5 <> 0),
renamed AS (SELECT DISTINCT app_id, CASE WHEN custkey % 50 = 1 THEN 'renamed.space' ELSE hostname END AS hostname,
  drain FROM bind WHERE custkey % 5 <> 0)"""


def _diff_sql(desired: str) -> str:
    return f"""WITH {_HELD_DESIRED}
SELECT coalesce(h.app_id, d.app_id) AS app_id, coalesce(h.hostname, d.hostname) AS hostname,
  coalesce(h.drain, d.drain) AS drain,
  CASE WHEN d.app_id IS NULL THEN 'remove' WHEN h.app_id IS NULL THEN 'add' ELSE 'kept' END AS action
FROM held h FULL JOIN {desired} d ON h.app_id = d.app_id AND h.hostname = d.hostname AND h.drain = d.drain"""


@query(_diff_sql("desired"))
def join4_snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot_diff(*_held_and_desired(spark, sf_dir, renamed=False))


@query(_diff_sql("renamed"))
def join5_rename_as_remove_and_add(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot_diff(*_held_and_desired(spark, sf_dir, renamed=True))


@query(f"WITH {sql.BIND} SELECT DISTINCT app_id, hostname, drain FROM bind")
def set1_distinct_bindings(spark: SparkSession, sf_dir: str) -> DataFrame:
    every = views.bindings(spark, sf_dir)
    doubled = every.unionByName(every.filter(F.col("custkey") % 10 == 0))
    return distinct_bindings(doubled)


@query(f"WITH {sql.BIND} SELECT app_id, hostname, drain FROM bind WHERE custkey % 10 <> 3")
def set3_removed_bindings(spark: SparkSession, sf_dir: str) -> DataFrame:
    every = views.bindings(spark, sf_dir)
    gone = every.filter(F.col("custkey") % 10 == 3).withColumn("hostname", F.col("hostname"))
    never_held = gone.withColumn("hostname", F.lit("no.such.space"))
    return remove_bindings(every, gone.unionByName(never_held)).select(*BINDING_KEY)


@query(
    f"""WITH {sql.PARSED}
SELECT app_id AS source_id, 'LGR' AS source_type, '' AS instance_id,
  'Invalid syslog drain URL: parse failure' AS payload FROM parsed WHERE NOT parse_ok"""
)
def log1_unparsable_drains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selflogs.reject_logs(_validated(spark, sf_dir).filter(F.col("reject_reason") == validation.PARSE))


@query(
    """SELECT source_id, e.source_type AS source_type, e.instance_id AS instance_id, payload FROM (
  SELECT 'app-' || (c_custkey % 200) AS source_id, 'Invalid syslog drain URL: parse failure' AS payload,
    unnest([{'source_type': 'LGR', 'instance_id': ''}, {'source_type': 'SYS', 'instance_id': '3'}]) AS e
  FROM customer WHERE c_custkey % 6 = 5)"""
)
def log2_unreadable_drains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The drains with a bad start, without their scheme: what is left has a stray colon."""
    bindings = views.bindings(spark, sf_dir)
    cut = bindings.withColumn("drain", F.regexp_replace("drain", "^bad:", ""))
    return selflogs.unreadable_drain_logs(cut, "3")


@query(
    f"""WITH {_VALIDATED_PAGES}
SELECT app_id AS source_id, 'LGR' AS source_type, '' AS instance_id,
  'Failed to resolve syslog drain host: ' || host AS payload
FROM page_checked WHERE scheme IN ('syslog', 'syslog-tls', 'https') AND found IS NULL"""
)
def log3_unresolved_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejects = _validated_pages(spark, sf_dir).filter(F.col("reject_reason") == validation.UNRESOLVED)
    return selflogs.reject_logs(rejects)


@query(
    f"""WITH {sql.VALIDATED}, {_VALIDATED_PAGES.replace(sql.RANGES + ',', '')}
SELECT app_id AS source_id, 'LGR' AS source_type, '' AS instance_id,
  'Syslog drain blacklisted: ' || host || ' (' || ip || ')' AS payload
FROM validated WHERE reject_reason = 'blocked'
UNION ALL
SELECT app_id, 'LGR', '', 'Syslog drain blacklisted: ' || host || ' (' || ip || ')'
FROM page_checked WHERE scheme IN ('syslog', 'syslog-tls', 'https') AND is_blocked"""
)
def log4_blocked_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    every = _validated(spark, sf_dir).unionByName(_validated_pages(spark, sf_dir))
    return selflogs.reject_logs(every.filter(F.col("reject_reason") == validation.BLOCKED))


@query(
    f"""WITH {sql.SELECTED}
SELECT app_id AS source_id, 'SYS' AS source_type, '3' AS instance_id, 'Invalid drain-type' AS payload
FROM selected WHERE NOT drain_type_ok"""
)
def log5_invalid_drain_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selflogs.drain_type_logs(with_kinds(views.bindings(spark, sf_dir), True), "3")


@query(
    f"""WITH {sql.VALIDATED}
SELECT 'drains' AS name, count(*) AS value FROM validated WHERE reject_reason IS NULL"""
)
def agg6_drains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.drains(validation.kept_bindings(_validated(spark, sf_dir)))


@query(
    f"""WITH {sql.VALIDATED}
SELECT count_if(reject_reason IS NULL) AS "drainCount",
  count_if(reject_reason IS NOT NULL) AS "blacklistedOrInvalidUrlCount" FROM validated"""
)
def agg9_health_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.drain_health(_validated(spark, sf_dir))


@query(
    f"""WITH {sql.VALIDATED}, {sql.WORKERS}
SELECT '{{"adapterCount":' || (SELECT count(*) FROM workers)
  || ',"blacklistedOrInvalidUrlCount":' || count_if(reject_reason IS NOT NULL)
  || ',"drainCount":' || count_if(reject_reason IS NULL) || '}}' AS health FROM validated"""
)
def snk8_health_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first drain counts, of the pages, are overwritten by those of the customers."""
    counters = metrics.health_counters(
        metrics.worker_health(views.workers(spark, sf_dir)),
        metrics.drain_health(_validated_pages(spark, sf_dir)),
        metrics.drain_health(_validated(spark, sf_dir)),
    )
    return metrics.health_json(counters)
