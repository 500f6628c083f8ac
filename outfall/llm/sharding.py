"""Sharding by a Feistel permutation of global row numbers.

Rows are numbered from 0 in an order of their content, so that a number does not depend on files
or partitions. A keyed Feistel network permutes the numbers; a result beyond the last row is
permuted again until it is inside (cycle walking), which keeps it a permutation. The shard is
the permuted number modulo the shard count, the slot the quotient. Both directions can be
computed for any row without a look at the data, given seed, row count and shard count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from outfall.llm.words import BROADCAST_ROWS, settled_small, whole_text
from outfall.session import settle

ROUNDS = 6
#: Rows that one numbering bucket holds about; each is ordered in one task.
BUCKET_ROWS = 100_000
MIN_BUCKETS = 512
_MASK = (1 << 64) - 1


def round_keys(seed: int, rounds: int = ROUNDS) -> list[int]:
    """One 64-bit key per round, by a Weyl sequence with a mixing step."""
    return [int(_mixed(np.uint64((seed + (i + 1) * 0x9E3779B97F4A7C15) & _MASK))) for i in range(rounds)]


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Permutation:
    """A permutation of 0 .. n - 1 that is computed, never stored."""

    def __init__(self, n: int, seed: int, rounds: int = ROUNDS):
        if n < 0:
            raise ValueError("a permutation needs a size of 0 or more")
        self.n = n
        self.half = np.uint64(max(1, (max(n - 1, 1).bit_length() + 1) // 2))
        self.low = np.uint64((1 << int(self.half)) - 1)
        self.keys = [np.uint64(k) for k in round_keys(seed, rounds)]

    def _once(self, x: np.ndarray, keys: list, back: bool) -> np.ndarray:
        left, right = x >> self.half, x & self.low
        for key in keys:
            if back:
                left, right = right ^ (_mixed(left ^ key) & self.low), left
            else:
                left, right = right, left ^ (_mixed(right ^ key) & self.low)
        return (left << self.half) | right

    def _walk(self, numbers, keys: list, back: bool) -> np.ndarray:
        x = np.asarray(numbers, dtype=np.uint64)
        if len(x) and int(x.max()) >= self.n:
            raise ValueError("a row number is not below the row count")
        x = self._once(x, keys, back)
        outside = np.flatnonzero(x >= np.uint64(self.n))
        while len(outside):
            x[outside] = self._once(x[outside], keys, back)
            outside = outside[x[outside] >= np.uint64(self.n)]
        return x.astype(np.int64)

    def forward(self, numbers) -> np.ndarray:
        return self._walk(numbers, self.keys, False)

    def backward(self, numbers) -> np.ndarray:
        return self._walk(numbers, self.keys[::-1], True)


def row_at(shard: int, slot: int, n: int, seed: int, shards: int) -> int:
    """The row number that stands at a place."""
    return int(Permutation(n, seed).backward([slot * shards + shard])[0])


def with_row_numbers(df: DataFrame, name: str = "row_number", max_rows: int = BROADCAST_ROWS) -> tuple[DataFrame, int]:
    """Number the rows from 0 without gaps; also returns the row count.

    Rows lie in buckets by a hash of all their columns, and in a bucket by these columns. Rows that agree in all of
    them are one row with a count until they are numbered, and are numbered in parts, so that there may be any number.
    """
    names = df.columns
    groups = settle(df.groupBy(*names).agg(F.count(F.lit(1)).alias("_n")))
    n = groups.agg(F.sum("_n")).first()[0] or 0
    buckets = max(MIN_BUCKETS, -(-groups.count() // BUCKET_ROWS))
    dealt = groups.withColumn("_bucket", F.pmod(F.xxhash64(*names), F.lit(buckets)))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        dealt.groupBy("_bucket")
        .agg(F.sum("_n").alias("_size"))
        .select("_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    )
    inside = Window.partitionBy("_bucket").orderBy(*names).rowsBetween(Window.unboundedPreceding, -1)
    first = F.col("_start") + F.coalesce(F.sum("_n").over(inside), F.lit(0))
    numbered = dealt.join(settled_small(starts, max_rows), "_bucket").withColumn("_first", first)
    parts = numbered.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(_n - 1) div {BUCKET_ROWS}"))))
    begin = F.col("_part") * BUCKET_ROWS
    rows = F.explode(F.sequence(begin, F.least(begin + BUCKET_ROWS, F.col("_n")) - 1))
    return parts.withColumn("_row", rows).select(*names, (F.col("_first") + F.col("_row")).cast("long").alias(name)), n


def permuted(number: Column, n: int, seed: int) -> Column:
    @F.pandas_udf("long")
    def walk(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        permutation = Permutation(n, seed)
        for part in parts:
            yield pd.Series(permutation.forward(part.to_numpy()))

    return walk(number)


def assign_shards(docs: DataFrame, shards: int, seed: int) -> DataFrame:
    """A shard and slot for every row of ``docs`` (``doc_id``, ``text``), by the law ``rows``.

    Shards differ by one row at most, slots have no gaps. Returns ``doc_id``, ``size`` (UTF-8
    bytes of the text, null: none, plus 1), ``text_crc32``, ``row_number``, ``shard`` and
    ``slot``. Rows that repeat id and text are alike and take any of their places. An empty table
    gives an empty one.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    text = whole_text(F.col("text"))
    narrow = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    numbered, n = with_row_numbers(narrow)
    return (
        numbered.withColumn("_place", permuted(F.col("row_number"), n, seed))
        .withColumn("shard", F.pmod("_place", F.lit(shards)).cast("int"))
        .withColumn("slot", F.floor(F.col("_place") / shards).cast("long"))
        .drop("_place")
    )
