"""Every registered query against its SQL, on the smallest sample tables."""

import os
from collections import Counter

import pytest

from outfall.plans.catalog import CHECKS, QUERIES

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no sample tables")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_sql(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    order = sorted(result.columns)
    got = Counter(map(tuple, result.select(*[f"`{c}`" for c in order]).collect()))
    check = duck.execute(CHECKS[name])
    names = [c[0] for c in check.description]
    assert sorted(names) == order
    at = [names.index(c) for c in order]
    assert got == Counter(tuple(row[i] for i in at) for row in check.fetchall())
