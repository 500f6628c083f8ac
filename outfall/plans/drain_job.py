"""The drain table job: one term reads a snapshot, checks it, places it and writes the result.

A term is written to a folder of its own, and becomes the current one by a last, small append
to the list of terms. A term that fails before that leaves everything as it was.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from outfall.operators import metrics, selflogs
from outfall.operators.bindings import distinct_bindings
from outfall.operators.placement import COPIES, MAX_BINDINGS, cap_workers, healthy_workers, rebalance
from outfall.operators.routing import shares
from outfall.operators.validation import kept_bindings, rejected_bindings, validate_bindings
from outfall.schema import BINDING, BINDING_KEY, HELD
from outfall.session import temporary_folders
from outfall.sources import versions
from outfall.sources.drain_table import IncompleteSnapshot, fetch_bindings

#: Terms whose tables stay, for those who still read them and for looking back.
KEEP_TERMS = 100


def last_term(spark: SparkSession, state_dir: str) -> int:
    """Number of the current term, 0 before the first."""
    return versions.last_version(spark, state_dir, "terms", "term")


def read_state(spark: SparkSession, state_dir: str, table: str, term: int | None = None) -> DataFrame:
    term = term if term is not None else last_term(spark, state_dir)
    return spark.read.parquet(f"{state_dir}/term={term}/{table}")


def current_bindings(spark: SparkSession, state_dir: str) -> Callable[[], DataFrame]:
    """A reader of the bindings of the term that counts when it is called, for ``start_fan_out``."""
    return lambda: _current(spark, state_dir, "bindings", BINDING)


def worker_shares(spark: SparkSession, state_dir: str, worker: str) -> Callable[[], DataFrame]:
    """A reader of what one worker serves in the current term, with its share of each binding's stream."""
    return lambda: shares(_current(spark, state_dir, "assignment", HELD), worker)


def _current(spark: SparkSession, state_dir: str, table: str, schema: StructType) -> DataFrame:
    term = last_term(spark, state_dir)
    if term == 0:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{state_dir}/term={term}/{table}")


def held_copies(spark: SparkSession, state_dir: str) -> DataFrame:
    """Copies that workers hold after the current term, also those of workers that did not answer."""
    term = last_term(spark, state_dir)
    if term == 0:
        return spark.createDataFrame([], HELD)
    answered = read_state(spark, state_dir, "assignment", term).select("worker", *BINDING_KEY)
    return answered.unionByName(read_state(spark, state_dir, "away", term))


def read_held(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A snapshot of what the workers that answered say they hold."""
    return spark.read.schema(HELD).format(fmt).load(path)


def refresh(
    landed: DataFrame,
    dns: DataFrame,
    ranges: DataFrame,
    workers: DataFrame,
    state_dir: str,
    copies: int = COPIES,
    max_bindings: int = MAX_BINDINGS,
    held: DataFrame | None = None,
) -> bool:
    """Run one term. False if the snapshot was not whole, and then nothing has changed.

    ``held`` is what the workers that answered report to hold; without it, what the last term
    gave them. Copies on workers that do not answer can be neither kept nor removed: they are
    written to ``away``, and settled in the term in which the worker is back. The reason of a
    refused snapshot is appended to ``refused``, with the number of the term that it would have been.
    """
    with temporary_folders(landed.sparkSession):
        return _term(landed, dns, ranges, workers, state_dir, copies, max_bindings, held)


def _term(landed, dns, ranges, workers, state_dir, copies, max_bindings, held) -> bool:
    spark = landed.sparkSession
    try:
        bindings = fetch_bindings(landed)
    except IncompleteSnapshot as fault:
        refused = spark.createDataFrame([(last_term(spark, state_dir) + 1, str(fault))], "term long, reason string")
        refused.write.mode("append").parquet(f"{state_dir}/refused")
        return False
    term = last_term(spark, state_dir) + 1
    folder = f"{state_dir}/term={term}"

    def write(df: DataFrame, table: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{folder}/{table}")
        return spark.read.parquet(f"{folder}/{table}")

    known = held_copies(spark, state_dir)
    held = known if held is None else held.select("worker", *BINDING_KEY)
    answering = healthy_workers(workers)
    write(known.join(answering, "worker", "left_anti").select("worker", *BINDING_KEY), "away")
    # Several steps read the bindings; the pages are parsed for them once.
    fetched = write(bindings, "fetched")
    validated = write(validate_bindings(fetched, dns, ranges), "validated")
    kept = kept_bindings(validated)
    moves = write(rebalance(held, kept, workers, copies), "moves")
    wanted = moves.filter(F.col("action") != "remove").select(
        "worker",
        *BINDING_KEY,
        (F.col("action") == "add").alias("is_new"),
        F.lit(0).alias("arrival"),
    )
    placed = write(cap_workers(wanted, max_bindings), "placed")
    refused = placed.filter(~F.col("is_accepted"))
    write(
        selflogs.reject_logs(rejected_bindings(validated)).unionByName(selflogs.not_scheduled_logs(refused)),
        "self_logs",
    )
    health = metrics.health_counters(metrics.worker_health(workers), metrics.drain_health(validated))
    write(metrics.health_json(health), "health")
    write(distinct_bindings(kept), "bindings")
    assignment = write(placed.filter("is_accepted").select("worker", *BINDING_KEY), "assignment")
    counted = [
        metrics.drains(kept), metrics.adapters(workers), metrics.bad_connections(workers), metrics.rejected_bindings(placed),
        metrics.drain_bindings(assignment).select("worker", F.lit("drain_bindings").alias("name"), F.col("drain_bindings").alias("value")),
    ]
    write(metrics.written(*counted, now=F.current_timestamp()), "metrics")
    # Only now does the term count.
    versions.settle_version(spark, state_dir, term, "terms", "term")
    if term > KEEP_TERMS:
        versions.remove(spark, f"{state_dir}/term={term - KEEP_TERMS}")
    return True
