"""Workers on a hash ring, as tables.

Every worker has some points on a ring of 60-bit numbers, and a binding goes to the workers whose points come
next after its own number. The ring is a table of buckets, ranges of numbers that hold about ``BUCKET_POINTS`` points
each: a bucket is one row with its points in order and the first workers after its end. So a binding finds its
workers by an equi-join on the bucket and a look into one short array, and no task sees all workers.

A worker that leaves hands its bindings to those who come next, and no other binding moves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outfall.operators.skew import BROADCAST_BYTES, skew_join
from outfall.session import settle

#: Points of each worker. More of them make the shares of the workers more even.
POINTS = 16
#: Points that a bucket has about. Points are hashes, so no bucket has many times as much.
BUCKET_POINTS = 64
_HEX, _BITS = 15, 60


def position(text: Column) -> Column:
    """A place on the ring: the first 60 bits of the md5."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, _HEX), 16, 10).cast("long")


def _bucket(place: Column, bits: int) -> Column:
    return F.shiftrightunsigned(place, _BITS - bits)


def _first_distinct(workers: Column, n: int) -> Column:
    return F.slice(F.array_distinct(workers), 1, n)


def ring(workers: DataFrame, n: int, points: int = POINTS, bucket_points: int = BUCKET_POINTS) -> tuple[DataFrame, int]:
    """The buckets for ``n`` different workers in a row, and the number of bits of a bucket's number.

    ``workers`` has ``worker``, repeats do not count. A bucket has ``bucket``, ``points`` (``place``,
    ``worker``, in order) and ``after``: the first ``n`` different workers behind its end, around the ring.
    """
    named = workers.select("worker").dropDuplicates()
    count = named.count()
    bits = max(0, (count * points // bucket_points)).bit_length()
    placed = named.withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit(points - 1)))).select(
        "worker", position(F.concat("worker", F.lit("|"), F.col("_i").cast("string"))).alias("place")
    )
    gathered = placed.groupBy(_bucket(F.col("place"), bits).alias("bucket")).agg(
        F.sort_array(F.collect_list(F.struct("place", "worker"))).alias("points")
    )
    nothing = F.array().cast("array<struct<place:bigint,worker:string>>")
    every = named.sparkSession.range(1 << bits).withColumnRenamed("id", "bucket")
    buckets = settle(every.join(gathered, "bucket", "left").withColumn("points", F.coalesce("points", nothing)))

    # The first workers of each bucket; a bucket that has too few takes those of 1, 2, 4 ... buckets on.
    heads = buckets.select("bucket", _first_distinct(F.col("points.worker"), n).alias("head"))
    reach = 1
    while reach < 1 << bits and not heads.filter(F.size("head") < min(n, count)).isEmpty():
        on = heads.select(F.pmod(F.col("bucket") - reach, F.lit(1 << bits)).alias("bucket"), F.col("head").alias("_more"))
        heads = settle(
            heads.join(on, "bucket").select("bucket", _first_distinct(F.concat("head", "_more"), n).alias("head"))
        )
        reach *= 2
    after = heads.select(F.pmod(F.col("bucket") - 1, F.lit(1 << bits)).alias("bucket"), F.col("head").alias("after"))
    return settle(buckets.join(after, "bucket")), bits


def with_next_workers(
    bindings: DataFrame,
    workers: DataFrame,
    key: Column,
    n: int | None,
    name: str = "candidates",
    points: int = POINTS,
    bucket_points: int = BUCKET_POINTS,
    max_broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add ``name``: the ``n`` different workers that come next after ``key``, or all if there are fewer or ``n`` is null."""
    n = max(1, workers.select("worker").dropDuplicates().count()) if n is None else n
    buckets, bits = ring(workers, n, points, bucket_points)
    placed = bindings.withColumn("_place", position(key)).withColumn("_bucket", _bucket(F.col("_place"), bits))
    # Bindings are hashed as well, so no bucket is a hot key.
    found = skew_join(placed, buckets.withColumnRenamed("bucket", "_bucket"), ["_bucket"], ["_place"], "inner", max_broadcast_bytes)
    own = F.transform(F.filter("points", lambda p: p["place"] >= F.col("_place")), lambda p: p["worker"])
    return found.withColumn(name, _first_distinct(F.concat(own, "after"), n)).drop("_place", "_bucket", "points", "after")
