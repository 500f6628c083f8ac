"""Joins and rankings that hold up when one key has a large share of all rows.

Three rules are kept throughout: a side is broadcast only after its size was measured, or when
its row count has a fixed bound; a key that gives one task too much, read or made, is spread over several, by a hash of row
content so that a recomputed task gives the same rows; and nothing is dropped to get there.
"""

from __future__ import annotations

from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outfall.session import settle

#: Text size up to which a joined side is sent to all executors.
BROADCAST_BYTES = 64 * 1024 * 1024
#: Rows that one key may give one task: those of one side, and those that come out.
TASK_ROWS = 2_000_000
#: A join that makes very many rows has a task for so many times ``TASK_ROWS``, and no more tasks than the second number.
TASK_SHARES, JOIN_TASKS = 10, 4096
#: No more keys than this are hot; where there would be more, as of 10^12 rows, the bound is raised.
HOT_KEYS = 500_000
#: Rows of a key that a micro-batch is taken to have where nothing is known of it.
UNKNOWN_ROWS = 100_000
#: Lanes for rows without a key, which match nothing.
_KEYLESS = 1024
#: First hex digits of an md5 that name an ordering bucket; 16 ** 3 buckets.
_BUCKET_DIGITS = 3


def _width(schema: T.StructType) -> Column:
    """About the bytes of a row."""
    fixed, texts = 8, []
    for field in schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            texts.append(F.coalesce(F.octet_length(F.col(f"`{field.name}`")), F.lit(0)))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            texts.append(F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f"`{field.name}`")))), F.lit(0)))
        fixed += 16
    return reduce(add, texts, F.lit(fixed)).cast("long")


def fits_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure ``df`` against the limit."""
    size = df.agg(F.coalesce(F.sum(_width(df.schema)), F.lit(0)).alias("size")).first()["size"]
    return size <= max_bytes


def skew_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    spread_by: list[str],
    how: str = "inner",
    max_broadcast_bytes: int = BROADCAST_BYTES,
    heat: DataFrame | None = None,
    task_rows: int = TASK_ROWS,
    is_settled: bool = False,
) -> DataFrame:
    """Equi-join ``left`` with ``right`` on the columns ``on``.

    A ``right`` that is measured to be small is broadcast and ``left`` is not shuffled at all; only where ``is_settled`` says
    that ``left`` is a written table, which is read quickly, it is dealt out if one task would make most of the rows.
    Otherwise a key that has more than ``task_rows`` rows, on either side or in the result, is dealt out: ``left``
    by the hash of ``spread_by`` into some lanes, ``right`` by that of its row into others, and every lane of
    one side meets every lane of the other. ``how``: inner, left, left_semi, left_anti; but for inner, only ``left`` is dealt.
    Where many rows come out, tasks are not merged: Spark goes by the bytes that they read.

    A stream cannot be counted first. ``heat`` (``on``, ``n``) may say how many rows of each key a micro-batch has about,
    as counted in earlier ones.
    """
    if fits_broadcast(right, max_broadcast_bytes):
        if is_settled:
            left = _dealt(left, right.groupBy(*on).agg(F.count(F.lit(1)).alias("_r")), on, spread_by, task_rows)
        return left.join(F.broadcast(right), on, how)
    if heat is not None:
        counts = heat.select(*on, F.col("n").alias("_l"))
    elif left.isStreaming:
        counts = right.select(*on).dropDuplicates().withColumn("_l", F.lit(UNKNOWN_ROWS))
    else:
        counts = left.groupBy(*on).agg(F.count(F.lit(1)).alias("_l"))
    hot, made = _lanes(counts, right.groupBy(*on).agg(F.count(F.lit(1)).alias("_r")), on, how, task_rows)
    tasks = _join_tasks(left, made, how, task_rows)
    hot = F.broadcast(hot) if fits_broadcast(hot, BROADCAST_BYTES) else hot

    # A row without a key matches nothing, whichever lane it is in.
    keyless = reduce(or_, [F.col(c).isNull() for c in on])
    zero, mine = F.lit(0).cast("long"), F.xxhash64(*[F.col(f"`{f.name}`") for f in right.schema.fields if _hashable(f.dataType)])
    spread = left.join(hot, on, "left").withColumn(
        "_lane", F.pmod(F.xxhash64(*spread_by), F.when(keyless, _KEYLESS).otherwise(F.coalesce("_a", F.lit(1))))
    )
    copies = right.join(hot, on, "left").withColumn("_lane", F.explode(F.sequence(zero, F.coalesce("_a", F.lit(1)) - 1)))
    if how != "inner":
        return _joined(spread.drop("_a", "_b"), copies.drop("_a", "_b"), [*on, "_lane"], how, tasks).drop("_lane")
    spread = spread.withColumn("_turn", F.explode(F.sequence(zero, F.coalesce("_b", F.lit(1)) - 1)))
    copies = copies.withColumn("_turn", F.pmod(mine, F.coalesce("_b", F.lit(1))))
    return _joined(spread.drop("_a", "_b"), copies.drop("_a", "_b"), [*on, "_lane", "_turn"], how, tasks).drop("_lane", "_turn")


def _join_tasks(left: DataFrame, made: float, how: str, task_rows: int) -> int | None:
    """Tasks for so many rows that come out, or None where Spark may choose."""
    spark = left.sparkSession
    if left.isStreaming or how not in ("inner", "left") or made <= task_rows * spark.sparkContext.defaultParallelism:
        return None
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(JOIN_TASKS, int(made / (TASK_SHARES * task_rows))))


def _joined(left: DataFrame, right: DataFrame, on: list[str], how: str, tasks: int | None) -> DataFrame:
    if tasks is not None:
        left, right = left.repartition(tasks, *on), right.repartition(tasks, *on)
    return left.join(right, on, how)


def _dealt(left: DataFrame, matches: DataFrame, on: list[str], spread_by: list[str], task_rows: int) -> DataFrame:
    """``left``, dealt out by the hash of ``spread_by`` if one of its tasks would make over ``task_rows`` rows and over a core's part of all.

    Tasks follow the files, and a small file can hold the rows that have the most matches. ``matches`` (``on``, ``_r``) counts them.
    """
    cores = left.sparkSession.sparkContext.defaultParallelism
    tasks = left.select(*on, F.spark_partition_id().alias("_task")).join(F.broadcast(matches), on).groupBy("_task").agg(F.sum("_r").alias("_made"))
    made = tasks.agg(F.coalesce(F.sum("_made"), F.lit(0)).alias("all"), F.coalesce(F.max("_made"), F.lit(0)).alias("most")).first()
    if made["most"] <= max(task_rows, made["all"] / cores):
        return left
    return left.repartition(max(4 * cores, min(JOIN_TASKS, made["all"] // (TASK_SHARES * task_rows))), *spread_by)


def _hashable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_hashable(f.dataType) for f in kind.fields)
    return _hashable(kind.elementType) if isinstance(kind, T.ArrayType) else not isinstance(kind, T.MapType)


def _lanes(left: DataFrame, right: DataFrame, on: list[str], how: str, task_rows: int) -> tuple[DataFrame, float]:
    """The hot keys, and into how many lanes ``left`` (``_a``) and ``right`` (``_b``) are dealt; and the rows of all keys.

    The two are chosen so that the rows that are copied are fewest.
    """
    both = left.join(right, on).withColumn("_out", F.greatest(F.col("_l") * F.col("_r"), F.col("_l"), F.col("_r")))
    both = settle(both)
    total = both.agg(F.sum(F.col("_out").cast("double"))).first()[0] or 0.0
    bound = max(task_rows, int(total / HOT_KEYS))
    cells = F.ceil(F.col("_out") / bound).cast("double")
    even = F.ceil(F.sqrt(cells * F.col("_l") / F.col("_r")))
    a = cells if how != "inner" else F.greatest(F.lit(1), F.least(even, cells))
    hot = both.filter(F.col("_out") > bound).withColumn("_a", F.least(a, F.col("_l")).cast("long"))
    b = F.lit(1) if how != "inner" else F.least(F.ceil(cells / F.col("_a")), F.col("_r"))
    return settle(hot.select(*on, "_a", b.cast("long").alias("_b"))), total


def group_edges(
    df: DataFrame,
    keys: list[str],
    rank_by: Column,
    limit: int,
    spread_by: list[str],
    max_broadcast_bytes: int = BROADCAST_BYTES,
    counts: DataFrame | None = None,
) -> DataFrame:
    """For every group of more than ``limit`` rows: its size and its ``limit``-th smallest rank.

    Returns ``keys``, ``_n`` and ``_edge``, written to the shared folder. ``rank_by`` must tell
    the rows of a group apart. Only the keys and the rank are shuffled. A group is first ranked
    in parts, about as many as make the two rounds equally large, and only the first ``limit``
    of each part go on to the second. ``counts`` (``keys``, ``_n``) may be given if there is a
    cheaper way to them.
    """
    if counts is None:
        counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    over = settle(counts.filter(F.col("_n") > limit))
    if limit <= 0 or over.isEmpty():
        nowhere = F.lit(None).cast(df.select(rank_by).schema[0].dataType)
        return over.withColumn("_edge", nowhere)
    split = over.withColumn("_parts", F.ceil(F.sqrt(F.col("_n") / limit)).cast("long"))
    narrow = df.select(*keys, rank_by.alias("_edge"), F.xxhash64(*spread_by).alias("_spread"))
    parts = skew_join(narrow, split, keys, ["_spread"], "inner", max_broadcast_bytes).withColumn(
        "_part", F.pmod("_spread", "_parts")
    )
    in_part = Window.partitionBy(*keys, "_part").orderBy("_edge")
    in_group = Window.partitionBy(*keys).orderBy("_edge")
    return settle(
        parts.withColumn("_rank", F.row_number().over(in_part))
        .filter(F.col("_rank") <= limit)
        .withColumn("_rank", F.row_number().over(in_group))
        .filter(F.col("_rank") == limit)
        .select(*keys, "_n", "_edge")
    )


def mark_first(
    df: DataFrame,
    edges: DataFrame,
    keys: list[str],
    rank_by: Column,
    spread_by: list[str],
    max_broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add ``is_first``: whether a row is before or at the edge of its group.

    Every row is returned. All rows of a group without an edge are first.
    """
    joined = skew_join(df, edges, keys, spread_by, "left", max_broadcast_bytes)
    within = F.coalesce(rank_by <= F.col("_edge"), F.lit(False))
    return joined.withColumn("is_first", F.col("_n").isNull() | within).drop("_n", "_edge")


def running_start(df: DataFrame, key: Column, weight: Column, name: str) -> DataFrame:
    """Add ``name``: the sum of ``weight`` over all rows before this one in md5 order of ``key``.

    ``key`` must be different in every row. With weight 1 this is a dense index from 0. Rows
    are ordered within md5 buckets, which the hash keeps equally large, and the buckets' sums,
    one row each and 4096 at most, are added up in a second step: no window spans the table.
    """
    hashed = df.withColumn("_md5", F.md5(key.cast("binary"))).withColumn("_weight", weight.cast("long"))
    bucketed = hashed.withColumn("_bucket", F.substring("_md5", 1, _BUCKET_DIGITS))
    sums = bucketed.groupBy("_bucket").agg(F.sum("_weight").alias("_sum"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("_bucket", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    inside = (
        Window.partitionBy("_bucket").orderBy("_md5").rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        bucketed.withColumn("_inside", F.coalesce(F.sum("_weight").over(inside), F.lit(0)))
        .join(F.broadcast(starts), "_bucket")
        .withColumn(name, F.col("_start") + F.col("_inside"))
        .drop("_md5", "_weight", "_bucket", "_inside", "_start")
    )


def ordered_start(df: DataFrame, order: list[str], weight: Column, name: str) -> DataFrame:
    """Add ``name``: the sum of ``weight`` over all rows before this one in the order of the columns ``order``.

    These must tell all rows apart. The table is dealt by ranges and written down, so that the ranges stay as they
    are; rows are then added up inside their range, and the ranges' sums, one row each, in a second step.
    """
    dealt = settle(
        df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()).withColumn("_weight", weight.cast("long"))
    )
    sums = dealt.groupBy("_range").agg(F.sum("_weight").alias("_sum"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("_range", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        dealt.withColumn("_inside", F.coalesce(F.sum("_weight").over(inside), F.lit(0)))
        .join(F.broadcast(starts), "_range")  # a row per shuffle partition
        .withColumn(name, F.col("_start") + F.col("_inside"))
        .drop("_range", "_weight", "_inside", "_start")
    )
