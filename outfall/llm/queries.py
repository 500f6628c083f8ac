"""Queries that apply each operator to its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outfall.llm import bpe, collocations, exact_dedup, kneser_ney, maxent, mixing, pii, prefix_trie, repetition, sentence_spans, sharding, simhash, token_files
from outfall.llm.words import bound_batches
from outfall.session import send_code_with_tasks, shared_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}

SHARDS, SHARD_SEED = 16, 20_240_601
END_ID = 1
#: The power to which shares are raised, the seed of the lots, and the part of all tokens that the mix should have.
MIX_POWER, MIX_SEED, MIX_SHARE = 0.8, 7, 0.8


def tokenizer_path() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def prepare(spark: SparkSession) -> None:
    """What tasks in Python need of a session: this package, and batches of bounded size."""
    send_code_with_tasks(spark)
    bound_batches(spark)


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return build(spark, sf_dir)

    run.__name__, run.__doc__ = build.__name__, build.__doc__
    QUERIES[build.__name__] = run
    return run


@query
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark_copies(documents(spark, sf_dir))


CHECKS["op1_exact_dedup"] = r"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS normal FROM documents)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY normal) AS keep_id,
       count(*) OVER (PARTITION BY normal) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY normal) AS kept,
       sha256(normal) AS text_sha256
FROM t
"""


@query
def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(documents(spark, sf_dir))


@query
def op3_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that lose sentences, with what is left of them and where the repeats come first."""
    return sentence_spans.cleaned(documents(spark, sf_dir))


@query
def op4_repetition_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.repetition(documents(spark, sf_dir))


@query
def op5_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign_shards(documents(spark, sf_dir), SHARDS, SHARD_SEED)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "row_number",
    )


def trusted_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents labelled as good and not toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return labels.filter("quality = 1 AND coalesce(toxic, 0) = 0").select("doc_id")


@query
def op6_kneser_ney_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.perplexities(documents(spark, sf_dir), trusted_documents(spark, sf_dir)).drop("tag")


@query
def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_copies(documents(spark, sf_dir), shingle=3)
    return found.select("doc_id", simhash.as_hex(F.col("fp")).alias("fingerprint"), "component_id")


@query
def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    to = shared_dir(spark)
    token_files.write_tokens(documents(spark, sf_dir), tokenizer_path(), to, END_ID)
    return token_files.read_documents(spark, to)


def mixing_dimensions() -> dict:
    return {"source": F.col("source"), "lang": F.col("lang"), "topic": mixing.content_topic(F.col("text"))}


@query
def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    mixed = mixing.mix(docs, mixing_dimensions(), MIX_POWER, MIX_SEED, MIX_SHARE)
    return mixed.select(
        "doc_id", "source", "lang", mixing.content_topic(F.col("text")).alias("topic"),
        F.col("_tokens").alias("cell_tokens"), F.col("_weight").alias("cell_weight"), "probability", "kept",
    )


@query
def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(documents(spark, sf_dir), tokenizer_path())


@query
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(documents(spark, sf_dir))


CHECKS["op11_collocations"] = r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, regexp_extract_all(unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS ws FROM d),
i AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM p),
s AS (SELECT lang, ws, i, unnest([1, 2, 3]) AS m FROM i),
f AS (
  SELECT lang, m, array_to_string(ws[i:i + m - 1], ' ') AS phrase, count(*) AS f
  FROM s WHERE i + m - 1 <= len(ws) GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE m = 1 GROUP BY lang),
c AS (SELECT lang, m, phrase, string_split(phrase, ' ') AS ws, f AS a FROM f WHERE m >= 2 AND f >= 10),
k AS (SELECT *, unnest(range(1, m)) AS k FROM c),
cuts AS (
  SELECT k.lang, k.m, k.phrase, k.a, k.k, x.f AS l, y.f AS r,
         1000000::HUGEINT * k.a * k.a // (x.f::HUGEINT * y.f) AS score
  FROM k JOIN f x ON x.lang = k.lang AND x.phrase = array_to_string(k.ws[1:k.k], ' ')
         JOIN f y ON y.lang = k.lang AND y.phrase = array_to_string(k.ws[k.k + 1:], ' ')),
weakest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
  SELECT lang, phrase, max(a) AS around FROM (
    SELECT lang, a, array_to_string(ws[1:2], ' ') AS phrase FROM c WHERE m = 3
    UNION ALL SELECT lang, a, array_to_string(ws[2:3], ' ') FROM c WHERE m = 3) GROUP BY lang, phrase),
stay AS (
  SELECT w.lang, w.phrase, w.a, w.l, w.r, w.score FROM weakest w LEFT JOIN inside o USING (lang, phrase)
  WHERE o.around IS NULL OR 100 * o.around < 50 * w.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM stay JOIN n USING (lang) QUALIFY rank <= 2000
"""


#: Conversations that share starts, and the number of turns from which on none is shared.
TRIE_GROUP, TRIE_STARTS = 20, 4


@query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"), TRIE_GROUP, TRIE_STARTS)


CHECKS["op12_prefix_trie"] = r"""
WITH c AS (
  SELECT DISTINCT conv_id, conv_id - conv_id % 20 AS d, xor(4294967295, list_reduce(
    list_transform(string_split(conv_id::VARCHAR, ''), lambda s: ascii(s)::BIGINT),
    lambda x, b: list_reduce([1, 2, 3, 4, 5, 6, 7, 8]::BIGINT[],
      lambda y, i: CASE WHEN y & 1 = 1 THEN xor(y >> 1, 3988292384) ELSE y >> 1 END, xor(x, b)),
    4294967295::BIGINT)) % 4 AS h
  FROM conversations WHERE conv_id IS NOT NULL),
g AS (
  SELECT conv_id, turn, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS tokens,
         md5(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest
  FROM conversations WHERE conv_id IS NOT NULL),
t AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) AS pos FROM g),
r AS (
  SELECT c.conv_id, 0 AS part, t.pos, t.digest, t.tokens FROM c JOIN t ON t.conv_id = c.d AND t.pos <= c.h
  UNION ALL SELECT c.conv_id, 1, t.pos, t.digest, t.tokens FROM c JOIN t ON t.conv_id = c.conv_id AND t.pos > c.h),
m AS (
  SELECT conv_id, row_number() OVER w AS depth, string_agg(digest, '') OVER w AS key, tokens FROM r
  WINDOW w AS (PARTITION BY conv_id ORDER BY part, pos ROWS UNBOUNDED PRECEDING)
  UNION ALL SELECT conv_id, 0, '', 0 FROM c),
l AS (SELECT *, depth = max(depth) OVER (PARTITION BY conv_id) AS last FROM m),
n AS (
  SELECT key, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(tokens) AS saved,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE last), '')) AS ends_sha256
  FROM l GROUP BY key, depth),
k AS (
  SELECT n.*, p.conv_id AS parent_conv_id, (SELECT count(*) FROM n x WHERE x.depth = n.depth + 1 AND starts_with(x.key, n.key)) AS n_children
  FROM n LEFT JOIN n p ON p.depth = n.depth - 1 AND p.key = left(n.key, 32 * p.depth))
SELECT k.conv_id, k.depth, k.parent_conv_id, k.n_convs, k.n_children, count(*) FILTER (WHERE x.n_children = 0) AS n_leaves,
       CAST(sum(x.saved) AS BIGINT) AS saved_tokens, k.ends_sha256
FROM k JOIN k x ON starts_with(x.key, k.key)
GROUP BY ALL
"""


@query
def op13_maxent_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent.language_model_scores(documents(spark, sf_dir))
