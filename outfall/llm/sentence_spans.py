"""Substring dedup by sliding spans of sentences.

From every sentence on, the shortest run of several sentences with enough words or characters is hashed, over
the words alone. Runs are joined globally by their hash; every occurrence but the first, in order
of document and place, is a repeat, and the sentences under a repeat are removed. Sentences end
at a line's end, after ``.``, ``!`` or ``?`` before white space, or after the full stops of other scripts; a sentence of
many words counts as several, so that text without marks is cut as well. It is cut where the words say so, not at a
fixed stride, so that a passage is cut alike wherever in a sentence it begins.

Texts are cut once, and their runs written down, some documents to a row. These rows exchange packed fingerprints
(``blocks``) to find the runs that occur again; only those become rows of their own and are joined by all 128 bits.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outfall.llm import blocks
from outfall.llm.words import BROADCAST_ROWS, carried, restored, whole_text
from outfall.operators.skew import fits_broadcast
from outfall.session import settle

#: A run has so many sentences at least, and so many words or characters in words; a longer sentence than the last is cut.
LEAST_SENTENCES = 2
LEAST_WORDS = 20
LEAST_CHARS = 80
MOST_WORDS = 12
#: A longer sentence is cut where the hash of the words on both sides is least among so many places before and after.
NEAR = 3
#: Runs in one written row.
SHARD_RUNS = 200_000
#: What ends a sentence before white space, and what ends it anywhere.
_ENDS, _STOPS = ".!?", "\u3002\uFF01\uFF1F\u0964\u061F"
_WHITE = r"\x20\x09-\x0D"
_SENTENCE = re.compile(rf"(?:[^\n{_ENDS}{_STOPS}]++|[{_ENDS}](?![{_WHITE}]))*+(?:[{_ENDS}{_STOPS}\n]|\Z)")
_SPACE = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+")


def _cuts(words: list[bytes]) -> list[int]:
    """How many words come before each cut of a long sentence; neither end is one.

    A cut depends on the ``NEAR`` + 1 words on both sides only. Where none comes for ``MOST_WORDS``, as in text
    that repeats a word, cuts follow at that stride from the last one.
    """
    least = [xxhash.xxh3_64_intdigest(a + b" " + b) for a, b in zip(words[:-1], words[1:], strict=True)]
    cuts, last = [], 0
    for i in range(NEAR, len(least) - NEAR):
        near = least[i - NEAR : i + NEAR + 1]
        if near.index(min(near)) == NEAR:
            cuts.extend(range(last + MOST_WORDS, i + 1, MOST_WORDS))
            last = i + 1
            cuts.append(last)
    cuts.extend(range(last + MOST_WORDS, len(words), MOST_WORDS))
    return cuts


def sentences(text: str) -> list[tuple[int, int, str]]:
    """Start, end and text (words joined by a space) of every sentence with a word."""
    found = []
    for m in _SENTENCE.finditer(text):
        begin, end = m.span()
        words = m.group().encode().split()
        if len(words) <= MOST_WORDS:
            if words:
                found.append((begin, end, b" ".join(words).decode()))
            continue
        ends = [w.end() for w in _SPACE.finditer(text, begin, end)]
        cuts = [0, *_cuts(words), len(words)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            found.append((ends[a - 1] if a else begin, ends[b - 1] if b < len(words) else end, b" ".join(words[a:b]).decode()))
    return found


def run_hashes(parts: list[tuple[int, int, str]]) -> tuple[list[int], bytes]:
    """End and 128-bit hash of the run that begins at each sentence; the last sentences have none."""
    chars = [len(p[2]) for p in parts]
    words = [p[2].count(" ") + 1 for p in parts]
    ends, hashes = [], []
    end = n_words = n_chars = 0
    for i in range(len(parts)):
        while end < len(parts) and (end - i < LEAST_SENTENCES or (n_words < LEAST_WORDS and n_chars - n_words < LEAST_CHARS)):
            n_words += words[end]
            n_chars += chars[end] + 1
            end += 1
        if end - i < LEAST_SENTENCES or (n_words < LEAST_WORDS and n_chars - n_words < LEAST_CHARS):
            break
        ends.append(end)
        hashes.append(xxhash.xxh3_128_digest(" ".join([p[2] for p in parts[i:end]])))
        n_words -= words[i]
        n_chars -= chars[i] + 1
    return ends, b"".join(hashes)


def runs(docs: DataFrame) -> DataFrame:
    """The runs of ``docs``, some documents to a row, written down.

    A row has ``shard``, and of its documents ``ids``, ``copies`` (hashes of the texts) and ``counts`` of
    runs; ``ends`` and ``hashes`` hold these for all runs, one after the other.
    """
    ids = docs.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = count(TaskContext.get().partitionId() << 33)
        kind, held, size = None, [], 0

        def row() -> pa.RecordBatch:
            found, copies, ends, hashes = zip(*held, strict=True)
            counts = [len(e) for e in ends]
            columns = [
                pa.array([next(numbers)]),
                pa.ListArray.from_arrays([0, len(held)], pa.array(found, kind)),
                pa.array([list(copies)], pa.list_(pa.int64())),
                pa.array([counts], pa.list_(pa.int32())),
                pa.array([np.concatenate([np.array(e, "<u4") for e in ends]).tobytes()], pa.binary()),
                pa.array([b"".join(hashes)], pa.binary()),
                pa.array([sum(counts)]),
            ]
            return pa.RecordBatch.from_arrays(columns, ["shard", "ids", "copies", "counts", "ends", "hashes", "size"])

        for batch in batches:
            kind = batch.column(0).type
            for doc_id, copy, text in zip(*(batch.column(c) for c in range(3)), strict=True):
                ends, hashes = run_hashes(sentences(text.as_py()))
                if ends:
                    held.append((doc_id.as_py(), copy.as_py(), ends, hashes))
                    size += len(ends)
                if size >= SHARD_RUNS:
                    yield row()
                    held, size = [], 0
        if held:
            yield row()

    text = whole_text(F.col("text"))
    schema = f"shard long, ids array<{ids}>, copies array<long>, counts array<int>, ends binary, hashes binary, size long"
    return settle(docs.select("doc_id", F.xxhash64(text).alias("copy"), text).mapInArrow(cut, schema))


def _sorted_keys(hashes: bytes, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order of a shard's runs by fingerprint, and their buckets and fingerprints in it."""
    keys = blocks.keys_of(np.frombuffer(hashes, "<u8")[::2], bits)
    order = np.argsort(keys, kind="stable")
    return order, *blocks.parts_of(keys[order])


def fingerprint_lists(shards: DataFrame, bits: int) -> DataFrame:
    """``bucket``, ``shard`` and the packed fingerprints of a shard's runs in the bucket, repeats included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, hashes in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                _, buckets, low = _sorted_keys(hashes, bits)
                found = [(b, blocks.packed(low[part])) for b, part in blocks.runs(buckets)]
                columns = [[b for b, _ in found], [shard] * len(found)]
                arrays = [*(pa.array(c, pa.int64()) for c in columns), pa.array([d for _, d in found], pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, ["bucket", "shard", "listed"])

    return shards.select("shard", "hashes").mapInArrow(run, "bucket long, shard long, listed binary")


def repeated_lists(lists: DataFrame) -> DataFrame:
    """Of every list, as ``again``, one bit for each fingerprint: whether the bucket has it twice or more."""

    def run(table: pa.Table) -> pa.Table:
        each = [blocks.unpacked(d, 1)[0] for d in table.column("listed").to_pylist()]
        _, which, n = np.unique(np.concatenate(each), return_inverse=True, return_counts=True)
        parts = np.split((n > 1)[which], np.cumsum([len(e) for e in each])[:-1])
        again = [blocks.packed_bits(p) if p.any() else None for p in parts]
        columns = [table.column("bucket"), table.column("shard"), pa.array(again, pa.binary())]
        return pa.Table.from_arrays(columns, ["bucket", "shard", "again"])

    found = lists.groupBy("bucket").applyInArrow(run, "bucket long, shard long, again binary")
    return found.filter(F.col("again").isNotNull())


def candidate_runs(shards: DataFrame, lists: DataFrame, bits: int) -> DataFrame:
    """``run``, ``doc_id``, ``copy``, ``begin`` and ``end`` of the runs whose fingerprint occurs again."""
    ids = shards.schema["ids"].dataType.elementType.simpleString()

    def run(shard: pa.Table, found: pa.Table) -> pa.Table:
        told = dict(zip(found.column("bucket").to_pylist(), found.column("again").to_pylist(), strict=True))
        results = []
        for i in range(shard.num_rows):
            one = {name: shard.column(name).slice(i, 1).combine_chunks() for name in shard.schema.names}
            hashes = one["hashes"][0].as_py()
            order, buckets, _ = _sorted_keys(hashes, bits)
            at = np.sort(order[blocks.unpacked_bits(buckets, told)])
            counts = one["counts"].flatten().to_numpy()
            starts = np.cumsum(counts) - counts
            doc = np.repeat(np.arange(len(counts)), counts)[at]
            ends = np.frombuffer(one["ends"][0].as_py(), "<u4")[at]
            digests = [hashes[16 * k : 16 * k + 16] for k in at.tolist()]
            picked = pa.array(doc, pa.int64())
            columns = [
                pa.array(digests, pa.binary()), one["ids"].flatten().take(picked), one["copies"].flatten().take(picked),
                pa.array((at - starts[doc]).astype(np.int32)), pa.array(ends.astype(np.int32)),
            ]
            results.append(pa.Table.from_arrays(columns, ["run", "doc_id", "copy", "begin", "end"]))
        return pa.concat_tables(results)

    schema = f"run binary, doc_id {ids}, copy long, begin int, end int"
    return shards.drop("size").groupBy("shard").cogroup(lists.groupBy("shard")).applyInArrow(run, schema)


def repeated_spans(docs: DataFrame) -> DataFrame:
    """Per document with a repeat: ``spans`` (first sentence and end, runs that overlap being one) and ``first_doc_ids``.

    Documents come in order of ``doc_id``, null first, then of the hash of their text. Rows that
    repeat both are one document here. Null texts count as empty.
    """
    shards = runs(docs)
    bits = blocks.bucket_bits(shards.agg(F.sum("size")).first()[0] or 0)
    found = settle(candidate_runs(shards, repeated_lists(fingerprint_lists(shards, bits)), bits))
    place = F.struct("doc_id", "copy", "begin")
    shared = settle(
        found.groupBy("run").agg(F.min(place).alias("_first"), F.max(place).alias("_last")).filter("_first <> _last").drop("_last")
    )
    # The same join at every size; Spark splits the partitions of runs that are frequent.
    again = found.join(shared, "run").filter(~place.eqNullSafe(F.col("_first")))
    return again.groupBy("doc_id", "copy").agg(
        _merged(F.sort_array(F.collect_set(F.struct("begin", "end")))).alias("spans"),
        F.sort_array(F.collect_set("_first.doc_id")).alias("first_doc_ids"),
    )


def _merged(spans: Column) -> Column:
    """Ascending spans with those that overlap or touch made one."""
    nothing = F.array().cast("array<struct<begin:int,end:int>>")

    def add(done: Column, span: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        longer = F.struct(last["begin"].alias("begin"), F.greatest(last["end"], span["end"]).alias("end"))
        joined = F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(longer))
        return F.when((F.size(done) > 0) & (last["end"] >= span["begin"]), joined).otherwise(
            F.concat(done, F.array(span))
        )

    return F.aggregate(spans, nothing, add)


def cut_out(text: str, spans: list[tuple[int, int]]) -> tuple[str, int, list[tuple[int, int]]]:
    """The text without the sentences under the spans, the number of sentences, and what was cut."""
    parts = sentences(text)
    gone = np.zeros(len(parts) + 1, np.int64)
    for begin, end in spans:
        gone[begin] += 1
        gone[end] -= 1
    under = np.cumsum(gone[:-1]) > 0
    kept, cut, at = [], [], 0
    for (begin, end, _), removed in zip(parts, under, strict=True):
        if removed:
            kept.append(text[at:begin])
            at = end
            if cut and cut[-1][1] == begin:
                cut[-1] = (cut[-1][0], end)
            else:
                cut.append((begin, end))
    kept.append(text[at:])
    return "".join(kept), len(parts), cut


def cleaned(docs: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """The documents that lose sentences, one row per row of ``docs``.

    Returns ``doc_id``, ``first_doc_ids`` (where the repeats occur first, null ids left out),
    ``n_sentences``, ``n_removed``, ``removed`` (character ranges, end exclusive) and ``text``, which is
    what is left. Documents that are not returned stay as they are.
    """
    spans = settle(repeated_spans(docs))
    keys = spans.select(F.col("doc_id").alias("_id"), F.col("copy").alias("_copy"), "spans", "first_doc_ids")
    text = whole_text(F.col("text"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("copy") == F.col("_copy"))
    texts = docs.select("doc_id", F.xxhash64(text).alias("copy"), text.alias("text"))
    touched = _touched(texts, spans, max_rows).join(_sized(keys, max_rows), same)

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = []
            for text, found in zip(batch.column(2), batch.column(3), strict=True):
                left, n, cut = cut_out(text.as_py(), [(s["begin"], s["end"]) for s in found.as_py()])
                done.append((n, _covered(found.as_py()), [f"{a}:{b}" for a, b in cut], left))
            n, lost, cut, left = zip(*done, strict=True) if done else ((), (), (), ())
            columns = [pa.array(n, pa.int64()), pa.array(lost, pa.int64()), pa.array(cut, pa.list_(pa.string())), pa.array(left, pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names)

    names = ["doc_id", "first_doc_ids", "n_sentences", "n_removed", "removed", "text"]
    ids = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {ids}, first_doc_ids array<{ids}>, n_sentences long, n_removed long, removed array<string>, text string"
    return touched.select("doc_id", "first_doc_ids", "text", "spans").mapInArrow(rewrite, schema)


def _touched(texts: DataFrame, spans: DataFrame, max_rows: int) -> DataFrame:
    """Without texts that have no spans, where these are few enough to be told apart before a shuffle."""
    copies = settle(spans.select(F.col("copy").alias("_copy")).distinct())
    if copies.count() > max_rows:
        return texts
    return texts.join(F.broadcast(copies), F.col("copy") == F.col("_copy"), "left_semi")


def _sized(spans: DataFrame, max_rows: int) -> DataFrame:
    """Rows of spans have no fixed width, so their bytes are measured before a broadcast."""
    return F.broadcast(spans) if max_rows and fits_broadcast(spans, 16 * 1024 * 1024) else spans


def _covered(spans: list[dict]) -> int:
    """The number of sentences under spans that are sorted."""
    total = at = 0
    for s in spans:
        total += max(0, s["end"] - max(at, s["begin"]))
        at = max(at, s["end"])
    return total


def dedup_spans(docs: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``docs`` with all their columns, repeated sentences removed from ``text``."""
    text = whole_text(F.col("text"))
    spans = repeated_spans(docs).select(F.col("doc_id").alias("_id"), F.col("copy").alias("_copy"), F.col("spans").alias("_spans"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64(text) == F.col("_copy"))

    @F.pandas_udf("string")
    def without(texts, found):
        import pandas as pd

        return pd.Series([cut_out(t, [(s["begin"], s["end"]) for s in f])[0] for t, f in zip(texts, found, strict=True)])

    found = F.coalesce("_spans", F.array().cast("array<struct<begin:int,end:int>>"))
    new = F.when(F.col("_spans").isNull(), F.col("text")).otherwise(without(text, found))
    rows = carried(docs).join(_sized(settle(spans), max_rows), same, "left")
    return restored(rows.select(F.col("_whole").withField("text", new).alias("_whole")))
