"""Every operator and stage over nulls, empty and long texts, repeated rows, no rows, and clashing columns."""

import pytest

import corpus_pipeline
from outfall.llm import (
    bpe, collocations, exact_dedup, kneser_ney, maxent, mixing, pii, repetition, sentence_spans, sharding, simhash, token_files, words,
)
from outfall.llm.queries import END_ID, mixing_dimensions, tokenizer_path
from outfall.session import shared_dir

LONG = "Some words of a long text, number 12. " * 30_000
ODD = [
    (1, "plain words here"), (2, None), (3, ""), (4, " \t\n "), (5, "plain  words\nhere"), (5, "plain  words\nhere"),
    (None, "no id at all"), (None, None), (7, LONG), (8, "9" * 20_000), (9, "a@" * 5_000 + "+1 (" * 2_000), (10, "é" * 5_000),
]


def tokens(df):
    to = shared_dir(df.sparkSession)
    token_files.write_tokens(df, tokenizer_path(), to, END_ID)
    return token_files.read_documents(df.sparkSession, to)


#: Operators that return a row for each row that they get.
EACH = {
    "exact": exact_dedup.mark_copies,
    "pii": pii.find_personal_data,
    "repetition": repetition.repetition,
    "sharding": lambda df: sharding.assign_shards(df, 16, 1),
    "simhash": simhash.near_copies,
    "tokens": tokens,
    "mixing": lambda df: mixing.mix(df, mixing_dimensions(), 0.8),
    "bpe": lambda df: bpe.encode_digests(df, tokenizer_path()),
    "maxent": maxent.language_model_scores,
    "perplexity": lambda df: kneser_ney.perplexities(df, df.filter("doc_id < 6").select("doc_id")),
}


@pytest.mark.parametrize("name", EACH)
def test_a_row_for_every_odd_row(docs, name):
    got = EACH[name](docs(ODD, clashes=True)).collect()
    assert len(got) == len(ODD)
    ids = [i for i, _ in ODD]
    assert sorted(r["doc_id"] or 0 for r in got) == sorted(i or 0 for i in ids)


@pytest.mark.parametrize("name", EACH)
def test_no_rows_give_no_rows(docs, name):
    assert EACH[name](docs([])).collect() == []


def test_sentence_spans_of_odd_rows(docs):
    assert sentence_spans.cleaned(docs([])).collect() == []
    got = {r["doc_id"]: r for r in sentence_spans.cleaned(docs(ODD, clashes=True)).collect()}
    assert 7 in got and got[7]["n_removed"] > 0.9 * got[7]["n_sentences"]
    assert set(got) <= {7, 8, 9, 10}
    back = sentence_spans.dedup_spans(docs(ODD, clashes=True))
    assert back.columns == docs([], clashes=True).columns and back.count() == len(ODD)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_with_odd_rows(spark, docs, sample, name, stage):
    for rows in (ODD, []):
        given = docs(rows, clashes=True)
        got = stage(spark, given, sample)
        assert got.columns[: len(given.columns)] == given.columns or name == "bpe_encoding"
        assert got.count() <= len(rows)


#: Operators that return rows of the table with all their columns.
WHOLE = {
    "drop_copies": exact_dedup.drop_copies,
    "drop_near_copies": simhash.drop_near_copies,
    "drop_rejected": lambda df: kneser_ney.drop_rejected(df, df.filter("doc_id < 6").select("doc_id")),
    "dedup_spans": sentence_spans.dedup_spans,
    "redact": lambda df: pii.redact(df, pii.find_personal_data(df).dropDuplicates(["doc_id"])),
    "sample": lambda df: mixing.sample(df, mixing_dimensions(), 0.8),
}


@pytest.mark.parametrize("name", WHOLE)
def test_columns_of_any_name_come_back(docs, name):
    given = docs([*ODD, (5, "mail me: a@b.org"), (11, "1 2 3")], clashes=True)
    got = WHOLE[name](given)
    assert got.schema.names == given.schema.names
    rows = got.collect()
    assert rows and all(r[c] == "x" for r in rows for c in ("a.b", "_sha", "_gone", "_id", "_mix_kept", "spans", "_cell_lang"))


def test_collocations_of_odd_rows(docs):
    assert collocations.collocations(docs([], clashes=True)).collect() == []
    phrases = {r["phrase"] for r in collocations.collocations(docs(ODD, clashes=True)).collect()}
    assert "of a long" in phrases


def test_many_spans_in_one_text(docs):
    """Two hundred thousand addresses, and as many numbers between them that look like others."""
    text = "".join(f"10.{i % 250}.{i // 250 % 250}.7 555-010-{i % 10_000:04d} " for i in range(200_000))
    import time

    begun = time.monotonic()
    row = pii.find_personal_data(docs([(1, text)])).first()
    assert row["n_ip"] == 200_000 and time.monotonic() - begun < 60


def test_batches_are_bounded_unless_smaller_ones_are_set(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    try:
        for held, size in (("64m", "4096"), ("1024", "1024")):
            spark.conf.set(key, held)
            words.bound_batches(spark, 4096)
            assert spark.conf.get(key) == size
    finally:
        spark.conf.set(key, before)
