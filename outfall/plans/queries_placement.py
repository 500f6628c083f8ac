"""Queries on placement: which workers serve which binding."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outfall.operators import metrics, placement, selflogs
from outfall.operators.bindings import distinct_bindings
from outfall.plans import drain_job, views
from outfall.plans import oracle_views as sql
from outfall.plans.registry import query
from outfall.schema import BINDING_KEY
from outfall.session import shared_dir
from outfall.sources.drain_table import read_pages

#: Cap of bindings per worker in the cap queries: some workers are over it, some are not.
_CAP = 420


def _bindings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_bindings(views.bindings(spark, sf_dir))


@query(
    f"""WITH {sql.BIND}, {sql.WORKERS}, {sql.ranked('candidates', 'bind', 'workers')}
SELECT app_id, hostname, drain, string_agg(worker, ',' ORDER BY place) AS candidates
FROM candidates GROUP BY app_id, hostname, drain"""
)
def join6_worker_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every worker, in the order in which they come next on the ring."""
    ranked = placement.with_candidates(_bindings(spark, sf_dir), views.workers(spark, sf_dir), None)
    return ranked.select(*BINDING_KEY, F.array_join("candidates", ",").alias("candidates"))


@query(
    f"""WITH {sql.BIND}, {sql.WORKERS}, {sql.placed('placed', 'bind', 'workers')}
SELECT app_id, hostname, drain, worker FROM placed"""
)
def rank1_two_workers_each(spark: SparkSession, sf_dir: str) -> DataFrame:
    return placement.place(_bindings(spark, sf_dir), views.workers(spark, sf_dir))


@query(
    f"""WITH {sql.BIND}, {sql.WORKERS},
indexed AS (SELECT app_id, hostname, drain, row_number() OVER (ORDER BY md5({sql.KEY})) - 1 AS i FROM bind),
numbered AS (SELECT worker, row_number() OVER (ORDER BY worker) - 1 AS n FROM workers)
SELECT app_id, hostname, drain, worker FROM indexed JOIN numbered
  ON n = (2 * i) % (SELECT count(*) FROM workers) OR n = (2 * i + 1) % (SELECT count(*) FROM workers)"""
)
def rank2_even_placement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return placement.place_evenly(_bindings(spark, sf_dir), views.workers(spark, sf_dir))


_HELD = f"""{sql.BIND}, {sql.WORKERS},
before AS (SELECT app_id, hostname, drain FROM bind WHERE custkey % 5 <> 4),
desired AS (SELECT app_id, CASE WHEN custkey % 50 = 1 THEN 'renamed.space' ELSE hostname END AS hostname, drain
  FROM bind WHERE custkey % 5 <> 0),
healthy AS (SELECT worker FROM workers WHERE healthy),
{sql.placed('held', 'before', 'workers')},
reported AS (SELECT h.* FROM held h JOIN healthy w ON w.worker = h.worker),
stays AS (SELECT r.*, d.app_id IS NOT NULL AS is_wanted FROM reported r LEFT JOIN desired d
  ON d.app_id = r.app_id AND d.hostname = r.hostname AND d.drain = r.drain)"""

_REBALANCED = f"""{_HELD},
loads AS (SELECT w.worker, count(s.worker) AS load FROM healthy w
  LEFT JOIN stays s ON s.worker = w.worker AND s.is_wanted GROUP BY w.worker),
levels AS (SELECT worker, load, row_number() OVER (ORDER BY load, worker) - 1 AS n,
    (row_number() OVER (ORDER BY load, worker) - 1) * load
    - coalesce(sum(load) OVER (ORDER BY load, worker ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS level
  FROM loads),
missing AS (SELECT d.app_id, d.hostname, d.drain, 2 - count(s.worker) AS m FROM desired d LEFT JOIN stays s
    ON s.is_wanted AND s.app_id = d.app_id AND s.hostname = d.hostname AND s.drain = d.drain
  GROUP BY ALL HAVING count(s.worker) < 2),
slots AS (SELECT *, coalesce(sum(m) OVER (ORDER BY md5({sql.KEY})
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS slot FROM missing),
turns AS (SELECT app_id, hostname, drain, m, t, slot + t AS s,
    (SELECT count(*) FROM levels l WHERE l.level <= slot + t) AS open_workers,
    (SELECT max(level) FROM levels l WHERE l.level <= slot + t) AS reached
  FROM (SELECT *, unnest(range(0, m)) AS t FROM slots)),
{sql.ranked('next_workers', 'slots', 'healthy')},
offers AS (
  SELECT app_id, hostname, drain, m, t AS pos, l.worker FROM turns JOIN levels l ON l.n = (s - reached) % open_workers
  UNION ALL
  SELECT n.app_id, n.hostname, n.drain, s.m, 10 + n.place, n.worker FROM next_workers n
    JOIN slots s ON s.app_id = n.app_id AND s.hostname = n.hostname AND s.drain = n.drain),
open_offers AS (SELECT o.app_id, o.hostname, o.drain, o.m, o.worker, min(o.pos) AS pos FROM offers o
  WHERE NOT EXISTS (SELECT 1 FROM stays s WHERE s.is_wanted AND s.worker = o.worker AND s.app_id = o.app_id
    AND s.hostname = o.hostname AND s.drain = o.drain)
  GROUP BY ALL),
rebalanced AS (
  SELECT worker, app_id, hostname, drain, 'add' AS action FROM (
    SELECT *, row_number() OVER (PARTITION BY app_id, hostname, drain ORDER BY pos) AS place FROM open_offers)
  WHERE place <= m
  UNION ALL
  SELECT worker, app_id, hostname, drain, CASE WHEN is_wanted THEN 'kept' ELSE 'remove' END FROM stays)"""


def _rebalanced(spark: SparkSession, sf_dir: str) -> DataFrame:
    every = views.bindings(spark, sf_dir)
    workers = views.workers(spark, sf_dir)
    held = placement.place(distinct_bindings(every.filter(F.col("custkey") % 5 != 4)), workers)
    name = F.when(F.col("custkey") % 50 == 1, "renamed.space").otherwise(F.col("hostname"))
    desired = every.filter(F.col("custkey") % 5 != 0).withColumn("hostname", name)
    return placement.rebalance(held, desired, workers)


@query(f"WITH {_REBALANCED} SELECT worker, app_id, hostname, drain, action FROM rebalanced")
def rank3_stable_rebalance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rebalanced(spark, sf_dir)


@query(
    f"""WITH {_REBALANCED}
SELECT worker, count(*) AS drain_bindings FROM rebalanced WHERE action <> 'remove' GROUP BY worker"""
)
def agg4_drain_bindings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.drain_bindings(_rebalanced(spark, sf_dir).filter(F.col("action") != "remove"))


@query(
    f"""WITH {sql.BIND}, {sql.WORKERS}, healthy AS (SELECT worker FROM workers WHERE healthy),
{sql.placed('placed', 'bind', 'healthy')}
SELECT app_id, hostname, drain, worker FROM placed"""
)
def rank4_healthy_workers_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    healthy = placement.healthy_workers(views.workers(spark, sf_dir))
    return placement.place(_bindings(spark, sf_dir), healthy)


_TERM = f"""{sql.VALIDATED},
{sql.LANDED.replace(sql.BIND + ',', '')},
landed_bindings AS (SELECT DISTINCT app_id, hostname, unnest(drains) AS drain FROM paged),
kept AS (SELECT DISTINCT l.app_id, l.hostname, l.drain FROM landed_bindings l
  JOIN validated v ON v.drain = l.drain AND v.app_id = l.app_id WHERE v.reject_reason IS NULL),
{sql.WORKERS}, healthy AS (SELECT worker FROM workers WHERE healthy),
indexed AS (SELECT app_id, hostname, drain, row_number() OVER (ORDER BY md5({sql.KEY})) - 1 AS i FROM kept),
numbered AS (SELECT worker, row_number() OVER (ORDER BY worker) - 1 AS n FROM healthy)"""


@query(
    f"""WITH {_TERM}
SELECT worker, app_id, hostname, drain FROM indexed JOIN numbered
  ON n = (2 * i) % (SELECT count(*) FROM healthy) OR n = (2 * i + 1) % (SELECT count(*) FROM healthy)"""
)
def rank5_failed_fetch_changes_nothing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A term on the whole snapshot, then one on a snapshot with a refused page."""
    state, landing = shared_dir(spark), shared_dir(spark)
    views.landed_pages(spark, sf_dir).write.json(landing)
    pages = read_pages(spark, landing)
    refused = pages.withColumn("status", F.when(F.col("requested_id") == 0, 500).otherwise(200))
    tables = (views.page_dns(spark, sf_dir), views.ranges(spark, sf_dir), views.workers(spark, sf_dir))
    drain_job.refresh(pages, *tables, state_dir=state, max_bindings=10**9)
    drain_job.refresh(refused, *tables, state_dir=state, max_bindings=10**9)
    return drain_job.read_state(spark, state, "assignment").select("worker", *BINDING_KEY)


@query(
    f"""WITH {_TERM}
SELECT app_id, hostname, drain, 2 AS copies FROM kept WHERE (SELECT count(*) FROM healthy) >= 2"""
)
def rank3_worker_away_and_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies that are left after a term, one without a third of the workers, and one with them again."""
    state, landing = shared_dir(spark), shared_dir(spark)
    views.landed_pages(spark, sf_dir).write.json(landing)
    pages, workers = read_pages(spark, landing), views.workers(spark, sf_dir)
    fewer = workers.withColumn("healthy", F.col("healthy") & (F.crc32(F.col("worker").cast("binary")) % 3 != 0))
    for now in (workers, fewer, workers):
        tables = (views.page_dns(spark, sf_dir), views.ranges(spark, sf_dir), now)
        drain_job.refresh(pages, *tables, state_dir=state, max_bindings=10**9)
    moves = [drain_job.read_state(spark, state, "moves", term) for term in (1, 2, 3)]
    change = F.when(F.col("action") == "add", 1).when(F.col("action") == "remove", -1).otherwise(0)
    return (
        reduce(DataFrame.unionByName, moves)
        .groupBy(*BINDING_KEY)
        .agg(F.sum(change).cast("int").alias("copies"))
        .filter("copies <> 0")
    )


_CAPPED = f"""{sql.BIND}, {sql.WORKERS}, {sql.placed('placed', 'bind', 'workers')},
capped AS (
  SELECT p.worker, p.app_id, p.hostname, p.drain, row_number() OVER (PARTITION BY p.worker
    ORDER BY b.custkey % 3 = 0, b.custkey, p.app_id, p.hostname, p.drain) <= {_CAP} AS is_accepted
  FROM placed p JOIN bind b ON b.app_id = p.app_id AND b.hostname = p.hostname AND b.drain = p.drain)"""


def _capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All bindings on two workers; every third is new and the key is the order of arrival."""
    bindings = views.bindings(spark, sf_dir)
    numbered = placement.with_candidates(bindings, views.workers(spark, sf_dir)).select(
        F.explode("candidates").alias("worker"),
        *BINDING_KEY,
        (F.col("custkey") % 3 == 0).alias("is_new"),
        F.col("custkey").alias("arrival"),
    )
    return placement.cap_workers(numbered, _CAP)


@query(f"WITH {_CAPPED} SELECT worker, app_id, hostname, drain, is_accepted FROM capped")
def rank6_worker_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _capped(spark, sf_dir).select("worker", *BINDING_KEY, "is_accepted")


@query(
    f"""WITH {_CAPPED}
SELECT 'rejected_bindings' AS name, count_if(NOT is_accepted) AS delta FROM capped"""
)
def agg5_rejected_bindings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.rejected_bindings(_capped(spark, sf_dir))


@query(
    f"""WITH {_CAPPED}
SELECT app_id AS source_id, 'LGR' AS source_type, worker AS instance_id,
  'Syslog adapter has failed to schedule your drain stream' AS payload FROM capped WHERE NOT is_accepted"""
)
def log7_not_scheduled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selflogs.not_scheduled_logs(_capped(spark, sf_dir).filter(~F.col("is_accepted")))


@query(f"WITH {sql.WORKERS} SELECT 'adapters' AS name, count_if(healthy) AS value FROM workers")
def agg7_adapters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.adapters(views.workers(spark, sf_dir))


@query(
    """SELECT 'bad_adapter_connections' AS name, count_if(s_suppkey % 7 = 3) AS delta FROM supplier"""
)
def agg8_bad_adapter_connections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every supplier row is one poll of its worker; worker 3 never answers."""
    polls = views.table(spark, sf_dir, "supplier").select((F.col("s_suppkey") % 7 != 3).alias("healthy"))
    return metrics.bad_connections(polls)
