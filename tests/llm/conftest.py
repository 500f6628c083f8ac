import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Extra columns whose names the operators use themselves, and some that need quoting.
CLASHES = [
    "kept", "keep_id", "spans", "row", "shard", "fp", "_weight", "probability", "n_words", "tag", "a.b", "a b", "_sha", "_hash",
    "_text", "_gone", "_lost", "_fp", "_id", "_tag", "_copy", "_spans", "copy", "_cell_lang", "_mix_kept", "_cell_source",
    "text_sha256", "begin", "end", "size", "_row", "_n", "known", "chunk", "body", "held", "label",
]


@pytest.fixture
def docs(spark):
    """Documents from texts, or from (id, text) pairs."""

    def make(rows, lang="en", source="s", clashes=False):
        full = []
        for i, row in enumerate(rows):
            doc_id, text = row if isinstance(row, tuple) else (i, row)
            full.append((doc_id, text, lang, source, None if text is None else len(text)))
        df = spark.createDataFrame(full, SCHEMA)
        if clashes:
            from pyspark.sql import functions as F

            df = df.select("*", *[F.lit("x").alias(c) for c in CLASHES])
        return df

    return make


@pytest.fixture(scope="session")
def sample():
    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("no sample tables")
    return folder
