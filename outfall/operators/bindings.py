"""Set operations on the binding table: a binding is equal in all of its columns or not at all."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outfall.schema import BINDING_KEY


def distinct_bindings(bindings: DataFrame) -> DataFrame:
    return bindings.select(*BINDING_KEY).dropDuplicates()


def remove_bindings(held: DataFrame, removed: DataFrame) -> DataFrame:
    """``held``, each once, without ``removed``; a row that is not held is ignored."""
    return snapshot_diff(held, removed).filter(F.col("action") == "remove").drop("action")


def snapshot_diff(held: DataFrame, desired: DataFrame, key: list[str] | None = None) -> DataFrame:
    """Rows to ``add``, to ``remove`` and ``kept``, in the column ``action``.

    One shuffle of each side: both are reduced to distinct keys with a flag and summed. A
    changed hostname is another key, so it comes out as one removal and one addition.
    """
    key = key or BINDING_KEY
    sides = held.select(*key, F.lit(1).alias("_side")).unionByName(
        desired.select(*key, F.lit(2).alias("_side"))
    )
    return (
        sides.groupBy(*key)
        .agg(F.bit_or("_side").alias("_sides"))
        .select(
            *key,
            F.when(F.col("_sides") == 1, "remove")
            .when(F.col("_sides") == 2, "add")
            .otherwise("kept")
            .alias("action"),
        )
    )

