"""What a drain has asked for: the kinds of envelope that its ``drain-type`` selects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outfall.functions import urls

LOGS = ("log",)
METRICS = ("gauge", "counter")


def _kinds(*names: str) -> Column:
    return F.array(*[F.lit(n) for n in names])


def with_kinds(bindings: DataFrame, metrics_enabled: bool) -> DataFrame:
    """Add ``kinds`` and ``drain_type_ok``. With metrics off every drain gets logs, unchecked."""
    if not metrics_enabled:
        return bindings.withColumn("kinds", _kinds(*LOGS)).withColumn("drain_type_ok", F.lit(True))
    wanted = urls.drain_type(F.col("drain"))
    kinds = (
        F.when(wanted == "metrics", _kinds(*METRICS))
        .when(wanted == "all", _kinds(*LOGS, *METRICS))
        .otherwise(_kinds(*LOGS))
    )
    return bindings.withColumn("kinds", kinds).withColumn(
        "drain_type_ok", wanted.isin("", "logs", "metrics", "all")
    )


def shard_id(app_id: Column, hostname: Column, drain: Column) -> Column:
    """Label of a binding's stream. Two bindings can share one: never use it as a key."""
    return F.concat(app_id, hostname, drain)
