"""SimHash near-dedup with pivot distance tables.

A fingerprint has a bit set if it is set in over half of the hashes of a text's word shingles.
Documents link when their fingerprints differ in a few bits, and components are the transitive
closure of the links. All work after the fingerprints is on distinct fingerprints, so copies, and
the texts without a word, which all have fingerprint zero, are one row each.

Pairs are searched for in buckets: of four 16-bit quarters, two at least agree when two bits
differ or fewer, so a pair shares one of six keys of two quarters. A bucket's pairs are first
discarded by a table of distances to fixed reference fingerprints (pivots): by the triangle
inequality these differ by the bit distance at most, in every coordinate. Survivors are verified.
Buckets that are too full for pairs take a way without pairs that gives the same components: each
member emits itself and its neighbours at one bit, and two fingerprints at two bits or fewer meet
in such a neighbour. A neighbour has few members whatever the data.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outfall.llm.words import BROADCAST_ROWS, carried, restored, small
from outfall.session import settle

HASH_SEED = 42
MAX_BITS = 2
#: Shingles that are hashed at once.
SLICE = 100_000
#: Fixed reference fingerprints: as many, from the golden ratio's Weyl sequence.
PIVOTS = 12
#: Members up to which a bucket's pairs are formed.
PAIR_BUCKET = 48
#: Edges that one task handles while components are found.
EDGES_PER_TASK = 200_000
_QUARTER = 16
_LOWER = bytes(range(256)).lower()


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The fingerprint of one text, as an unsigned number."""
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_digest
    set_in = np.zeros(64, np.int64)
    for at in range(0, n, SLICE):  # long texts in slices, so that their hashes are never all there
        hashes = b"".join([digest(b" ".join(words[i : i + shingle]), HASH_SEED) for i in range(at, min(at + SLICE, n))])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
        set_in += np.add.reduce(bits, axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * set_in > n).tobytes(), "big")


def with_fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``doc_id`` and ``fp``, the fingerprint as a signed long, for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], ["doc_id", "fp"])

    ids = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, f"doc_id {ids}, fp long")


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def pivots(count: int = PIVOTS) -> list[int]:
    """Signed 64-bit reference fingerprints by a Weyl sequence."""
    raw = [(i + 1) * 0x9E3779B97F4A7C15 % (1 << 64) for i in range(count)]
    return [p - (1 << 64) if p >> 63 else p for p in raw]


def _buckets(prints: DataFrame) -> DataFrame:
    """Six rows per fingerprint: the quarters of the key, and their bits."""
    keys = []
    for kept in combinations(range(4), 2):
        mask = sum(((1 << _QUARTER) - 1) << (_QUARTER * q) for q in kept)
        mask = mask - (1 << 64) if mask >> 63 else mask
        keys.append(F.struct(F.lit(mask).alias("mask"), F.col("fp").bitwiseAND(F.lit(mask)).alias("bits")))
    return prints.select("fp", F.explode(F.array(*keys)).alias("_k")).select("fp", "_k.mask", "_k.bits")


def links(prints: DataFrame, pair_bucket: int = PAIR_BUCKET) -> DataFrame:
    """Links between distinct fingerprints (column ``fp``, one row each) as ``a``, ``b``.

    Two fingerprints at ``MAX_BITS`` bits or fewer are joined by a link or by two links over a
    neighbour of both; a link joins no others.
    """
    rows = settle(_buckets(prints))
    sizes = rows.groupBy("mask", "bits").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    sizes = settle(sizes)
    shared = settle(rows.join(small(sizes), ["mask", "bits"]))

    cold = shared.filter(F.col("_n") <= pair_bucket).drop("_n")
    table = [F.bit_count(F.col("fp").bitwiseXOR(F.lit(p))).cast("byte").alias(f"d{i}") for i, p in enumerate(pivots())]
    cold = cold.select("*", *table)
    left = cold.select([F.col(c).alias(c if c in ("mask", "bits") else f"l_{c}") for c in cold.columns])
    right = cold.select([F.col(c).alias(c if c in ("mask", "bits") else f"r_{c}") for c in cold.columns])
    apart = reduce(F.greatest, [F.abs(F.col(f"l_d{i}") - F.col(f"r_d{i}")) for i in range(PIVOTS)])
    found = (
        left.join(right, ["mask", "bits"])
        .filter(F.col("l_fp") < F.col("r_fp"))
        .filter(apart <= MAX_BITS)
        .filter(F.bit_count(F.col("l_fp").bitwiseXOR(F.col("r_fp"))) <= MAX_BITS)
        .select(F.col("l_fp").alias("a"), F.col("r_fp").alias("b"))
    )

    # The bits outside the key may differ; a flip of each of them gives the neighbours.
    full = shared.filter(F.col("_n") > pair_bucket)
    one = F.expr("shiftleft(1L, _bit)")
    stars = (
        full.withColumn("_bit", F.explode(F.sequence(F.lit(-1), F.lit(63))))
        .filter((F.col("_bit") < 0) | (F.col("mask").bitwiseAND(one) == 0))
        .select("fp", F.when(F.col("_bit") < 0, F.col("fp")).otherwise(F.col("fp").bitwiseXOR(one)).alias("_z"))
        .distinct()
    )
    meets = stars.groupBy("_z").agg(F.collect_set("fp").alias("_fps"))  # 65 at most, by construction
    met = meets.filter(F.size("_fps") > 1).select(
        F.array_min("_fps").alias("a"), F.explode("_fps").alias("b")
    ).filter(F.col("a") != F.col("b"))
    return found.unionByName(met).distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node`` and ``root``, the smallest node reachable, for every node of ``edges`` (``a``, ``b``).

    Alternates two steps until nothing changes: every node's larger neighbours are linked to its
    smallest neighbour, then its smaller ones. Each step is an aggregation and a join; the edges
    are written to the shared folder after each round.
    """
    edges = settle(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct())
    before, size = None, edges.count()
    for _ in range(max_rounds):
        # Few edges need few tasks, and one task no exchange.
        edges = edges.coalesce(1 + size // EDGES_PER_TASK)
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("_m")).select("a", F.least("a", "_m").alias("_m"))
        large = both.filter(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("_m").alias("b"))
        large = settle(large.filter("a != b").distinct()).coalesce(1 + size // EDGES_PER_TASK)
        least = large.groupBy("a").agg(F.min("b").alias("_m"))
        lower = large.join(least, "a")
        edges = settle(
            lower.filter(F.col("b") != F.col("_m")).select(F.col("b").alias("a"), F.col("_m").alias("b"))
            .unionByName(least.select("a", F.col("_m").alias("b")))
            .filter("a != b")
            .distinct()
        )
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.col("b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before, size = now, now[0]
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def near_copies(
    docs: DataFrame,
    shingle: int = 3,
    pair_bucket: int = PAIR_BUCKET,
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """``doc_id``, ``fp`` and ``component_id`` for every row of ``docs`` (``doc_id``, ``text``).

    ``component_id`` is the smallest id reachable over links, the document itself included; rows
    with a null id take part and have the smallest id of the others, or null. Null texts count as
    empty, other columns are not read, repeated rows come back as often as they are there.
    """
    rows = settle(with_fingerprints(docs, shingle))
    firsts = settle(rows.groupBy("fp").agg(F.min("doc_id").alias("_first"), F.count(F.lit(1)).alias("_n")))
    roots = settle(components(links(firsts.select("fp"), pair_bucket)))
    rooted = firsts.join(small(roots, max_rows), F.col("fp") == F.col("node"), "left").withColumn(
        "_root", F.coalesce("root", "fp")
    )
    least = rooted.groupBy("_root").agg(F.min("_first").alias("component_id"), F.sum("_n").alias("_all"))
    # Documents that are alone have no row here.
    shared = settle(rooted.join(least.filter(F.col("_all") > 1), "_root").select("fp", "component_id"))
    alone = F.col("_fp").isNull()
    return rows.join(
        small(shared.withColumnRenamed("fp", "_fp"), max_rows), F.col("fp") == F.col("_fp"), "left"
    ).select("doc_id", "fp", F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def drop_near_copies(docs: DataFrame, shingle: int = 3, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of their component, with all their columns.

    Rows with a null id stay if their whole component has none; rows that repeat an id stay or go
    together.
    """
    found = near_copies(docs, shingle, max_rows=max_rows)
    gone = found.filter(~F.col("doc_id").eqNullSafe(F.col("component_id")))
    gone = settle(gone.select(F.col("doc_id").alias("_gone"), "fp").distinct())
    rows = carried(docs)
    if gone.filter(F.col("_gone").isNull()).isEmpty():
        return restored(rows.join(small(gone, max_rows), F.col("doc_id") == F.col("_gone"), "left_anti"))
    named = gone.filter(F.col("_gone").isNotNull())
    lost = gone.filter(F.col("_gone").isNull()).select(F.col("fp").alias("_lost"))
    ids = rows.filter(F.col("doc_id").isNotNull()).join(
        small(named, max_rows), F.col("doc_id") == F.col("_gone"), "left_anti"
    )
    nameless = rows.filter(F.col("doc_id").isNull()).withColumn("_fp", fingerprint_column(shingle)(F.col("text")))
    stay = nameless.join(small(lost, max_rows), F.col("_fp") == F.col("_lost"), "left_anti").drop("_fp")
    return restored(ids.unionByName(stay))


def fingerprint_column(shingle: int):
    @F.pandas_udf("long")
    def column(texts):
        import pandas as pd

        prints = np.array([fingerprint(t, shingle) for t in texts], np.uint64)
        return pd.Series(prints.view(np.int64))

    return column
