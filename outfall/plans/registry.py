"""Named queries over the sample tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from outfall.session import send_code_with_tasks

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(check: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name."""

    def add(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            send_code_with_tasks(spark)
            # The sample tables hold zone-less times that mean UTC.
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return build(spark, sf_dir)

        run.__name__ = build.__name__
        run.__doc__ = build.__doc__
        QUERIES[build.__name__] = run
        if check is not None:
            CHECKS[build.__name__] = check
        return run

    return add
