"""Which workers serve which binding.

A binding's own order of workers is that of a hash ring (``hash_ring``). Loads are filled up from below by two joins:
the number of a new copy falls into an interval between two levels of load, and that says the number of
its worker. Workers and bindings are both tables of any size; neither is ever in one row or one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from outfall.operators.hash_ring import with_next_workers
from outfall.operators.skew import BROADCAST_BYTES, group_edges, mark_first, ordered_start, running_start, skew_join
from outfall.schema import BINDING_KEY
from outfall.session import settle

#: Workers that serve one binding at the same time.
COPIES = 2
#: Bindings that one worker can hold.
MAX_BINDINGS = 500


def binding_text(*columns: Column) -> Column:
    """The whole key as one text, with a separator so that no two keys have the same."""
    parts = [F.coalesce(c, F.lit("")) for c in (columns or [F.col(k) for k in BINDING_KEY])]
    return F.concat_ws("\x1f", *parts)


def healthy_workers(workers: DataFrame) -> DataFrame:
    return workers.filter(F.col("healthy")).select("worker").dropDuplicates()


def with_candidates(bindings: DataFrame, workers: DataFrame, n: int | None = COPIES) -> DataFrame:
    """Add ``candidates``: the ``n`` workers that come next on the ring, or all of them, the preferred one first."""
    return with_next_workers(bindings, workers, binding_text(), n)


def place(bindings: DataFrame, workers: DataFrame, copies: int = COPIES) -> DataFrame:
    """Each binding on its ``copies`` preferred workers, or on all if there are fewer."""
    return with_candidates(bindings, workers, copies).select(*BINDING_KEY, F.explode("candidates").alias("worker"))


def numbered_workers(workers: DataFrame, *order: str) -> DataFrame:
    """Distinct workers with ``number``, from 0 by ``order`` and then by name."""
    return ordered_start(workers, [*order, "worker"], F.lit(1), "number")


def place_evenly(
    bindings: DataFrame, workers: DataFrame, copies: int = COPIES, max_broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Distinct ``bindings`` dealt out in turn, so that loads differ by one at most.

    Binding i goes to workers (i * copies) and following, modulo their number.
    """
    numbered = settle(numbered_workers(workers.select("worker").dropDuplicates()))
    count = numbered.count()
    indexed = running_start(bindings, binding_text(), F.lit(1), "index")
    if count == 0:
        return indexed.limit(0).select(*BINDING_KEY, F.lit("").alias("worker"))
    turns = F.sequence(F.lit(0), F.lit(min(copies, count) - 1))
    dealt = indexed.withColumn("_turn", F.explode(turns)).withColumn(
        "number", F.pmod(F.col("index") * copies + F.col("_turn"), F.lit(count))
    )
    return skew_join(dealt, numbered, ["number"], BINDING_KEY, "inner", max_broadcast_bytes).select(*BINDING_KEY, "worker")


def rebalance(
    held: DataFrame,
    desired: DataFrame,
    workers: DataFrame,
    copies: int = COPIES,
    max_broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The next assignment: ``worker``, binding, and ``action`` of add, remove or kept.

    Copies on healthy workers stay where they are, as long as they are wanted and not more than
    ``copies``. Missing ones go to the least loaded workers first. A binding never has two
    copies on one worker; where the fill order would do that, its own preferred workers step in,
    so that balance, not distinctness, gives way.

    ``held`` has the bindings that answered workers reported. Those of unhealthy workers are
    left out of the result: nothing can be removed from a worker that does not answer.
    """
    healthy = settle(healthy_workers(workers))
    wanted = desired.select(*BINDING_KEY)
    reported = skew_join(held.select("worker", *BINDING_KEY), healthy, ["worker"], BINDING_KEY, "left_semi", max_broadcast_bytes)

    # One row per binding: which workers hold it, and whether it is wanted. Repeats go here.
    state = (
        reported.withColumn("_wanted", F.lit(False))
        .unionByName(wanted.withColumn("worker", F.lit(None).cast("string")).withColumn("_wanted", F.lit(True)))
        .groupBy(*BINDING_KEY)
        .agg(F.bool_or("_wanted").alias("_wanted"), F.array_sort(F.collect_set("worker")).alias("_held"))
    )
    # Of too many copies those stay whose md5 with the key is largest.
    ranked = F.transform(
        "_held", lambda w: F.struct(F.md5(F.concat(binding_text(), F.lit("|"), w).cast("binary")).alias("score"), w.alias("worker"))
    )
    first = F.when(F.size("_held") <= copies, F.col("_held")).otherwise(
        F.transform(F.slice(F.sort_array(ranked, asc=False), 1, copies), lambda s: s["worker"])
    )
    stays = F.when(F.col("_wanted"), first).otherwise(F.array().cast("array<string>"))
    state = settle(state.withColumn("_kept", stays))

    loads = (
        state.select(F.explode("_kept").alias("worker"), F.lit(1).alias("_one"))
        .unionByName(healthy.withColumn("_one", F.lit(0)))
        .groupBy("worker")
        .agg(F.sum("_one").alias("load"))
    )
    missing = state.filter(F.col("_wanted") & (F.size("_kept") < copies)).withColumn(
        "_missing", F.lit(copies) - F.size("_kept")
    )
    numbered = settle(running_start(missing, binding_text(), F.col("_missing"), "_slot"))
    turns = numbered.withColumn("_turn", F.explode(F.sequence(F.lit(0), F.col("_missing") - 1)))
    filled = fill(turns.select(*BINDING_KEY, "_turn", (F.col("_slot") + F.col("_turn")).alias("slot")), loads, max_broadcast_bytes)
    offers = filled.groupBy(*BINDING_KEY).agg(F.sort_array(F.collect_list(F.struct("_turn", "worker"))).alias("_turns"))
    # Copies that are kept, and turns that are taken twice, leave as many of these as can be missing.
    ringed = with_next_workers(numbered, healthy, binding_text(), 2 * copies, "_next", max_broadcast_bytes=max_broadcast_bytes)
    chosen = F.slice(
        F.filter(
            F.array_distinct(F.concat("_turns.worker", "_next")),
            lambda w: ~F.array_contains(F.col("_kept"), w),
        ),
        1,
        F.col("_missing"),
    )
    added = (
        ringed.join(offers, BINDING_KEY)
        .select(F.explode(chosen).alias("worker"), *BINDING_KEY)
        .withColumn("action", F.lit("add"))
    )
    settled = state.select(F.explode("_held").alias("worker"), *BINDING_KEY, "_kept").select(
        "worker",
        *BINDING_KEY,
        F.when(F.array_contains("_kept", F.col("worker")), "kept").otherwise("remove").alias("action"),
    )
    return added.unionByName(settled)


def fill(slots: DataFrame, loads: DataFrame, max_broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Add ``worker`` to ``slots``: who takes the copy number ``slot`` when loads are filled up from below.

    ``slots`` are numbered from 0 without gaps; ``loads`` has ``worker`` and ``load``. With workers in order of load, those
    up to one load are as full as the next after as many copies as its ``level``; from there on they are served
    in turn. There are as many levels as different loads, and so at most the root of twice the number of all
    copies. Without workers there are no rows.
    """
    loads = settle(loads)
    sizes = loads.groupBy("load").agg(F.count(F.lit(1)).alias("_n"))
    so_far = Window.orderBy("load").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ahead = Window.orderBy("load")
    steps = sizes.withColumn("open", F.sum("_n").over(so_far)).withColumn("_sum", F.sum(F.col("load") * F.col("_n")).over(so_far))
    steps = steps.withColumn("level", F.col("open") * F.col("load") - F.col("_sum"))
    steps = settle(steps.withColumn("end", F.lead("level").over(ahead)).select("open", "level", "end"))
    # Of intervals and slots, those meet that share a stretch of ``width`` slots.
    last = slots.agg(F.max("slot")).first()[0]
    if last is None or steps.isEmpty():
        return slots.limit(0).withColumn("worker", F.lit(""))
    width = 1 + last // (4 * steps.count())
    until = F.least(F.coalesce(F.col("end") - 1, F.lit(last)), F.lit(last))
    stretches = (
        steps.filter(F.col("level") <= until)
        .withColumn("_until", until)
        .withColumn("_stretch", F.explode(F.sequence(F.expr(f"level div {width}"), F.expr(f"_until div {width}"))))
    )
    met = skew_join(
        slots.withColumn("_stretch", F.expr(f"slot div {width}")), stretches, ["_stretch"], ["slot"], "inner", max_broadcast_bytes
    ).filter(F.col("slot").between(F.col("level"), F.col("_until")))
    turn = F.pmod(F.col("slot") - F.col("level"), F.col("open"))
    numbered = numbered_workers(loads, "load").select("worker", "number")
    return skew_join(
        met.withColumn("number", turn).select(*slots.columns, "number"), settle(numbered), ["number"], ["slot"], "inner", max_broadcast_bytes
    ).drop("number")


def cap_workers(
    assignment: DataFrame,
    limit: int = MAX_BINDINGS,
    max_broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Mark with ``is_accepted`` what each worker takes, which is ``limit`` bindings at most.

    ``assignment`` has ``worker``, the binding, ``is_new`` and ``arrival``. Held bindings come
    first, then new ones by arrival; the key decides between equals.
    """
    order = F.struct("is_new", "arrival", *BINDING_KEY)
    edges = group_edges(assignment, ["worker"], order, limit, BINDING_KEY, max_broadcast_bytes)
    return mark_first(
        assignment, edges, ["worker"], order, BINDING_KEY, max_broadcast_bytes
    ).withColumnRenamed("is_first", "is_accepted")
