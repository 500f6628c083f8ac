"""The text pipeline: each stage takes (spark, docs, sf_dir), and its result is the next one's docs.

``run`` applies the stages to ``documents`` and writes each result to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from outfall.llm import bpe, exact_dedup, kneser_ney, mixing, queries, simhash
from outfall.session import settle


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go whose perplexity is too high for their language."""
    queries.prepare(spark)
    return kneser_ney.drop_rejected(docs, queries.trusted_documents(spark, sf_dir))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the smallest id stays."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near copies, the document with the smallest id stays."""
    queries.prepare(spark)
    return simhash.drop_near_copies(docs, shingle=3)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample of most tokens whose sources, languages and topics have flatter shares."""
    return mixing.sample(docs, queries.mixing_dimensions(), queries.MIX_POWER, queries.MIX_SEED, MIX_SHARE)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids."""
    queries.prepare(spark)
    return bpe.with_ids(docs, queries.tokenizer_path())


#: The part of all tokens that the mix should have.
MIX_SHARE = 0.8

STAGES = [
    ("quality_classifier", drop_low_quality),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("source_mixing", mix_sources),
    ("bpe_encoding", encode),
]

#: A language model, xxHash and BPE are beyond SQL; tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.documents(spark, sf_dir)
    for _, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir))
    return docs
