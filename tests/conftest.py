import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from outfall.session import local_session, send_code_with_tasks

    session = local_session("4", "outfall-tests")
    session.sparkContext.setLogLevel("ERROR")
    send_code_with_tasks(session)
    yield session
    session.stop()


@pytest.fixture
def column(spark):
    """Evaluate a column function over values: ``column(values, type, function)``."""
    from pyspark.sql import functions as F

    def evaluate(values, sql_type, function):
        rows = [(i, v) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, f"i int, v {sql_type}")
        result = df.select("i", function(F.col("v")).alias("r")).collect()
        return [r["r"] for r in sorted(result, key=lambda r: r["i"])]

    return evaluate
