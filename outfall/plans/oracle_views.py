"""The views of ``views.py`` in SQL, as ``WITH`` parts that the check queries put together."""

BIND = r"""bind AS (
  SELECT c_custkey AS custkey, 'app-' || (c_custkey % 200) AS app_id,
    lower(c_mktsegment) || '.space' AS hostname,
    CASE c_custkey % 6 WHEN 0 THEN 'syslog://' WHEN 1 THEN 'syslog-tls://'
      WHEN 2 THEN 'https://user:pass@' WHEN 3 THEN 'http://' WHEN 4 THEN 'SYSLOG://' ELSE 'bad:' END
    || '10.' || c_nationkey || '.' || (c_custkey % 256) || '.' || (c_custkey % 200 + 1)
    || ':' || (514 + c_custkey % 3)
    || CASE c_custkey % 5 WHEN 0 THEN '' WHEN 1 THEN '/?drain-type=logs' WHEN 2 THEN '/?drain-type=metrics'
       WHEN 3 THEN '/?drain-type=all' ELSE '/?drain-type=bogus' END AS drain
  FROM customer)"""

#: Key of a binding as one text, as placement uses it.
KEY = "app_id || chr(31) || hostname || chr(31) || drain"

PARSED = (
    BIND
    + r""",
parsed AS (
  SELECT *, regexp_matches(drain, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]') AS parse_ok,
    lower(regexp_extract(drain, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1)) AS scheme_text,
    regexp_extract(drain, '://(?:[^/?#]*@)?([^/?#]*)', 1) AS host_port_text,
    regexp_extract(drain, '://(?:[^/?#]*@)?([^/?#:]*)', 1) AS host_text,
    regexp_extract(drain, 'drain-type=(.*)$', 1) AS drain_type
  FROM bind)"""
)

SELECTED = (
    PARSED
    + r""",
selected AS (
  SELECT *, CASE drain_type WHEN 'metrics' THEN ['gauge', 'counter']
      WHEN 'all' THEN ['log', 'gauge', 'counter'] ELSE ['log'] END AS kinds,
    drain_type IN ('', 'logs', 'metrics', 'all') AS drain_type_ok
  FROM parsed)"""
)

#: Blocked ranges as numbers: the lower half of 10.n.0.0/16 for every even nation, and one address.
RANGES = r"""ranges AS (
  SELECT CAST(10 AS BIGINT) * 16777216 + n_nationkey * 65536 AS lo,
    CAST(10 AS BIGINT) * 16777216 + n_nationkey * 65536 + 32767 AS hi FROM nation WHERE n_nationkey % 2 = 0
  UNION ALL
  SELECT CAST(10 AS BIGINT) * 16777216 + c_nationkey * 65536 + 1 * 256 + 2,
    CAST(10 AS BIGINT) * 16777216 + c_nationkey * 65536 + 1 * 256 + 2 FROM customer WHERE c_custkey = 1)"""

VALIDATED = (
    PARSED
    + ",\n"
    + RANGES
    + r""",
validated AS (
  SELECT app_id, hostname, drain, custkey,
    CASE WHEN parse_ok THEN scheme_text END AS scheme,
    CASE WHEN parse_ok THEN host_text END AS host,
    CASE WHEN parse_ok AND scheme_text IN ('syslog', 'syslog-tls', 'https') THEN host_text END AS ip,
    CASE WHEN NOT parse_ok THEN 'parse'
      WHEN scheme_text NOT IN ('syslog', 'syslog-tls', 'https') THEN 'scheme'
      WHEN EXISTS (SELECT 1 FROM ranges r WHERE
        TRY_CAST(split_part(host_text, '.', 1) AS BIGINT) * 16777216 + TRY_CAST(split_part(host_text, '.', 2) AS BIGINT) * 65536
        + TRY_CAST(split_part(host_text, '.', 3) AS BIGINT) * 256 + TRY_CAST(split_part(host_text, '.', 4) AS BIGINT)
        BETWEEN r.lo AND r.hi) THEN 'blocked' END AS reject_reason
  FROM parsed)"""
)

ENV = r"""env AS (
  SELECT event_id AS env_id, ts, 'app-' || user_id AS source_id,
    CASE WHEN event_id % 5 = 0 THEN '' ELSE CAST(event_id % 4 AS VARCHAR) END AS instance_id,
    CASE WHEN event_id % 3 = 0 THEN 'my task' ELSE 'app' END AS source_type,
    CASE WHEN event_type = 'purchase' THEN 'gauge' WHEN event_type = 'signup' THEN 'counter'
      WHEN event_type = 'view' AND event_id % 10 = 0 THEN 'timer' ELSE 'log' END AS kind,
    CASE event_type WHEN 'error' THEN 11 WHEN 'click' THEN 14 ELSE -1 END AS log_priority,
    event_type || ' ' || CASE WHEN event_id % 7 = 0 THEN chr(0) ELSE '' END || props
      || CASE WHEN event_id % 11 = 0 THEN chr(10) ELSE '' END AS payload,
    event_type AS name, event_id * 10 AS total, event_id % 10 AS delta,
    value, CAST(round(value * 100) AS BIGINT) AS hundredths,
    CASE WHEN event_id % 2 = 0 THEN 'ms' ELSE 'a"b]\c' END AS unit,
    regexp_extract(props, '(\d+)', 1) AS k,
    epoch_us(ts) * 1000 + event_id % 1000 AS timestamp_ns,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS ts_text
  FROM events)"""

#: Text of the first gauge metric: plain, with a large exponent, and with a small one.
READING = r"""CASE env_id % 3
    WHEN 0 THEN regexp_replace(CAST(value AS VARCHAR), '\.0$', '')
    WHEN 1 THEN CASE WHEN hundredths * 1000 < 1000000 THEN CAST(hundredths * 1000 AS VARCHAR)
      ELSE substr(CAST(hundredths AS VARCHAR), 1, 1)
        || CASE WHEN length(rtrim(CAST(hundredths AS VARCHAR), '0')) > 1
           THEN '.' || substr(rtrim(CAST(hundredths AS VARCHAR), '0'), 2) ELSE '' END
        || 'e+' || lpad(CAST(length(CAST(hundredths AS VARCHAR)) + 2 AS VARCHAR), 2, '0') END
    ELSE regexp_replace(CAST(CAST(hundredths AS DOUBLE) / 1e7 AS VARCHAR), '\.0$', '') END"""

LOG_PROCESS = r"""'[' || CASE WHEN instance_id <> '' THEN replace(upper(source_type), ' ', '-') || '/' || instance_id
    ELSE upper(source_type) END || ']'"""

LOG_TEXT = r"""CASE WHEN ends_with(replace(payload, chr(0), ''), chr(10)) THEN replace(payload, chr(0), '')
    ELSE replace(payload, chr(0), '') || chr(10) END"""

UNIT = r"""replace(replace(replace(unit, '\', '\\'), '"', '\"'), ']', '\]')"""

#: One row per message of an envelope, without the hostname.
PARTS = (
    ENV
    + r""",
parts AS (
  SELECT env_id, source_id, kind, ts, ts_text, timestamp_ns, CAST(0 AS BIGINT) AS part, CAST(NULL AS VARCHAR) AS metric,
    log_priority AS priority, """
    + LOG_PROCESS
    + r""" AS procid, '-' AS sd, """
    + LOG_TEXT
    + r""" AS text FROM env WHERE kind = 'log'
  UNION ALL
  SELECT env_id, source_id, kind, ts, ts_text, timestamp_ns, 0, 'value', 14, '[' || instance_id || ']',
    '[gauge@47450 name="value" value="' || """
    + READING
    + r""" || '" unit="' || """
    + UNIT
    + r""" || '"]', chr(10) FROM env WHERE kind = 'gauge'
  UNION ALL
  SELECT env_id, source_id, kind, ts, ts_text, timestamp_ns, 1, 'k', 14, '[' || instance_id || ']',
    '[gauge@47450 name="k" value="' || k || '" unit=""]', chr(10) FROM env WHERE kind = 'gauge'
  UNION ALL
  SELECT env_id, source_id, kind, ts, ts_text, timestamp_ns, 0, name, 14, '[' || instance_id || ']',
    '[counter@47450 name="' || name || '" total="' || total || '" delta="' || delta || '"]', chr(10)
  FROM env WHERE kind = 'counter'),
heads AS (
  SELECT *, '<' || priority || '>1 ' || ts_text || ' ' AS head,
    ' ' || source_id || ' ' || procid || ' - ' || sd || ' ' || text AS tail,
    position(' ' IN procid) = 0 AS is_valid FROM parts)"""
)

ROUTED = (
    SELECTED
    + ",\n"
    + PARTS
    + r""",
routed AS (
  SELECT m.*, b.app_id, b.hostname, b.drain, b.custkey, b.scheme_text AS scheme
  FROM heads m JOIN selected b ON b.app_id = m.source_id AND list_contains(b.kinds, m.kind)),
messages AS (
  SELECT *, CASE WHEN scheme = 'https' THEN message
      ELSE octet_length(encode(message)) || ' ' || message END AS frame
  FROM (SELECT *, head || hostname || tail AS message FROM routed))"""
)

WORKERS = r"""workers AS (
  SELECT worker, worker <> 'w3' AS healthy FROM (SELECT DISTINCT 'w' || (s_suppkey % 7) AS worker FROM supplier))"""


def ring_place(text: str) -> str:
    """A place on the ring of workers."""
    return f"CAST('0x' || substr(md5({text}), 1, 15) AS BIGINT)"


def ranked(name: str, bindings: str, workers: str) -> str:
    """Each binding of one view with each worker of another, ``place`` 1 being the next one on the ring."""
    return f"""{name} AS (
  SELECT *, row_number() OVER (PARTITION BY app_id, hostname, drain ORDER BY far) AS place FROM (
    SELECT b.app_id, b.hostname, b.drain, w.worker,
      min((w.place - {ring_place(KEY)} + 1152921504606846976) % 1152921504606846976) AS far
    FROM {bindings} b CROSS JOIN (SELECT worker, {ring_place("worker || '|' || i")} AS place FROM {workers}, range(16) t(i)) w
    GROUP BY b.app_id, b.hostname, b.drain, w.worker))"""


def placed(name: str, bindings: str, workers: str) -> str:
    """Each binding of one view on its two preferred workers of another."""
    return f"""{ranked(name + '_ranked', bindings, workers)},
{name} AS (SELECT app_id, hostname, drain, worker FROM {name}_ranked WHERE place <= 2)"""


PAGE_HOSTS = r"""page_hosts AS (
  SELECT DISTINCT regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1) AS host FROM pages),
page_dns AS (
  SELECT host, '10.' || CAST('0x' || substr(md5(host), 1, 2) AS BIGINT) || '.'
    || CAST('0x' || substr(md5(host), 3, 2) AS BIGINT) || '.'
    || CAST('0x' || substr(md5(host), 5, 2) AS BIGINT) AS ip
  FROM page_hosts WHERE md5(host) NOT LIKE '0%')"""

LANDED = (
    BIND
    + r""",
paged AS (
  SELECT CAST(floor(custkey / 400) AS BIGINT) AS page, app_id, min(hostname) AS hostname, list(drain) AS drains
  FROM bind GROUP BY 1, 2)"""
)
