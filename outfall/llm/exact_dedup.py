"""Exact dedup: groups by a 128-bit content hash, checked byte by byte, smallest id stays.

Two texts are equal when they are identical after every run of white space became one space.
Null texts count as empty. Nothing but ids, hashes and sizes is shuffled for texts that occur
once. Texts whose hash occurs again are compared as bytes: they are grouped by hash *and* text,
and map-side aggregation leaves one row per task and text, so that a text with a third of all
rows costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outfall.llm.words import BROADCAST_ROWS, WHITE, carried, restored, small, whole_text
from outfall.session import settle

Digest = Callable[[Column], Column]


def normalised(text: Column) -> Column:
    return F.regexp_replace(whole_text(text), WHITE, " ")


def content_hash(normal: Column) -> Column:
    """128 bits of the normalised text."""
    return F.unhex(F.md5(normal.cast("binary")))


def mark_copies(
    docs: DataFrame,
    digest: Digest = content_hash,
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``): which row of its group stays.

    Returns ``doc_id``, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``. Other columns
    of ``docs`` are not read. Rows that repeat both id and text are the same row again: they
    count in ``group_size``, and one of them is ``kept`` at most. Rows with a null id stay only
    if no row of the group has an id. ``digest`` may be any hash; texts that share one without
    being equal form groups of their own.
    """
    normal = normalised(F.col("text"))
    rows = settle(
        docs.select("doc_id", normal.alias("_text"))
        .select("doc_id", digest(F.col("_text")).alias("_hash"), F.sha2("_text", 256).alias("text_sha256"))
        .groupBy("doc_id", "_hash", "text_sha256")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    again = settle(
        rows.groupBy("_hash").agg(F.sum("_n").alias("_rows")).filter(F.col("_rows") > 1).select("_hash")
    )
    texts = docs.select("doc_id", normal.alias("_text")).withColumn("_hash", digest(F.col("_text")))
    if again.count() <= max_rows:
        # Else grouping shuffles every text once, which a join would have to do as well.
        texts = texts.join(F.broadcast(again), "_hash", "left_semi")
    classes = settle(
        texts.groupBy("_hash", "_text")
        .agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .filter(F.col("group_size") > 1)
        .select("_hash", F.sha2("_text", 256).alias("text_sha256"), "keep_id", "group_size")
    )
    # Different bytes in a group got classes of their own; sha256 only names them.
    return (
        rows.join(small(classes, max_rows), ["_hash", "text_sha256"], "left")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_n").cast("int"))))
        .withColumn("_alone", F.col("group_size").isNull())
        .select(
            "doc_id",
            F.when(F.col("_alone"), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
            F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
            (F.col("_alone") | (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("_copy") == 1))).alias("kept"),
            "text_sha256",
        )
    )


def drop_copies(docs: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Rows that repeat id and text stay once, as the row whose other columns, as JSON, are smallest.
    """
    marks = settle(mark_copies(docs, max_rows=max_rows))
    gone = settle(marks.filter(~F.col("kept")).select("doc_id", "text_sha256"))
    stay = marks.filter(F.col("kept")).select("doc_id", "text_sha256")
    both = settle(gone.join(stay, _same_row(gone, stay), "left_semi").distinct())
    gone = small(settle(gone.distinct()), max_rows)
    named = carried(docs, F.sha2(normalised(F.col("text")), 256).alias("_sha"))
    kept = restored(named.join(gone, _is_row(named, gone), "left_anti"))
    if both.isEmpty():
        return kept
    repeated = named.join(small(both, max_rows), _is_row(named, both), "left_semi")
    others = F.to_json("_whole", {"ignoreNullFields": "false"})
    once = restored(repeated.groupBy("doc_id", "_sha").agg(F.min_by("_whole", others).alias("_whole")))
    return kept.unionByName(once)


def _same_row(left: DataFrame, right: DataFrame) -> Column:
    return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["text_sha256"] == right["text_sha256"])


def _is_row(docs: DataFrame, marks: DataFrame) -> Column:
    return docs["doc_id"].eqNullSafe(marks["doc_id"]) & (docs["_sha"] == marks["text_sha256"])
