import ast
import pathlib

import duckdb
import pytest

import corpus_pipeline
from outfall.llm import queries, simhash
from outfall.session import settle


def test_exact_dedup_sql(spark, sample):
    base = duckdb.connect()
    base.execute(f"CREATE VIEW documents AS SELECT * FROM '{sample}/documents.parquet'")
    for name, sql in queries.CHECKS.items():
        result = queries.QUERIES[name](spark, sample)
        columns = ", ".join(result.columns)
        assert sorted(map(tuple, result.collect())) == sorted(base.execute(f"SELECT {columns} FROM ({sql})").fetchall())


def test_stages_keep_what_they_should(spark, sample):
    docs = queries.documents(spark, sample)
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = settle(stage(spark, before, sample))
        assert 0 < docs.count() <= before.count()
        if name != "bpe_encoding":
            assert docs.columns == columns
            assert docs.exceptAll(before).isEmpty()
        if name == "exact_dedup":
            texts = [" ".join(r["text"].split()) for r in docs.collect()]
            assert len(texts) == len(set(texts))
        if name == "simhash_near_dedup":
            left = simhash.near_copies(before).select("component_id").distinct().count()
            assert docs.count() == left
    assert all(r["ids"] for r in docs.collect())


@pytest.mark.parametrize("name", ["outfall", "tests"])
def test_nothing_else_imports_the_package(name):
    top = pathlib.Path(__file__).parents[2]
    for file in (top / name).rglob("*.py"):
        if "llm" in file.relative_to(top).parts:
            continue
        for node in ast.walk(ast.parse(file.read_text())):
            names = [a.name for a in node.names] if isinstance(node, ast.Import) else []
            names += [node.module or ""] if isinstance(node, ast.ImportFrom) else []
            assert not any(n.startswith("outfall.llm") for n in names)
