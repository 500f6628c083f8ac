"""What the operators share: white space, words, and how tables that may be large are joined."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from outfall.session import settle

#: The white space between words: space, and tab to carriage return.
WHITE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
#: Rows up to which a settled table of a few plain columns is broadcast (about 64 MB of them).
BROADCAST_ROWS = 1_000_000
#: Bytes of a batch that is sent to Python. A batch is a few times in the memory of a task.
BATCH_BYTES = 4 * 1024 * 1024


def whole_text(text: Column) -> Column:
    """The text, with null as empty."""
    return F.coalesce(text.cast("string"), F.lit(""))


def carried(docs: DataFrame, *more: Column) -> DataFrame:
    """``doc_id``, ``text``, ``more``, and whole rows of ``docs`` in one column, which ``restored`` gives back.

    So no column of ``docs`` has the name of one that an operator makes, whatever it is called.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_whole")
    return docs.select("doc_id", "text", *more, whole)


def restored(rows: DataFrame) -> DataFrame:
    return rows.select("_whole.*")


def n_words(text: Column) -> Column:
    return F.regexp_count(whole_text(text), F.lit(WORD)).cast("long")


def small(settled: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``settled`` with a broadcast hint if it was counted to be small, else as it is.

    Beyond the limit the join is by shuffle, where Spark splits the partitions of hot keys.
    """
    return F.broadcast(settled) if settled.count() <= max_rows else settled


def settled_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Write ``df``, and hint its size as ``small`` does."""
    return small(settle(df), max_rows)


def bound_batches(spark: SparkSession, size: int = BATCH_BYTES) -> None:
    """Have the session send batches of ``size`` bytes at most, or one row; smaller settings stay.

    Spark's own limit counts rows above all, and ten thousand long texts are a lot. Results do not change.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark._jsparkSession.sessionState().conf().arrowMaxBytesPerBatch()
    if not 0 < now <= size:
        spark.conf.set(key, str(size))
