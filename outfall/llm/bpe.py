"""BPE encoding and decoding.

A piece is a doubly linked list of symbols. A priority queue holds the rank and place of every
pair that can be merged; the pair of the lowest rank, then the leftmost, is merged, and its new
neighbours are queued. Entries whose pair is gone are skipped when they come up. Decoding joins
the vocabulary's strings with a space, as a file without a decoder asks for.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outfall.llm.vocabulary import Remembered, Vocabulary, vocabulary


def merge(symbols: str, vocab: Vocabulary) -> list[int]:
    """The ids of one piece, which is not empty, given with its bytes as printable characters."""
    known, ranks = vocab.ids, vocab.ranks
    ids = [known[c] for c in symbols[:-1]]
    ids.append(known[symbols[-1] + vocab.word_end])
    n = len(ids)
    #: Of each place: the rank of the pair that begins there now, or -1.
    rank_at = [ranks.get(a << 32 | b, -1) for a, b in zip(ids, ids[1:], strict=False)]
    rank_at.append(-1)
    queue = [rank << 32 | i for i, rank in enumerate(rank_at) if rank >= 0]
    heapify(queue)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    while queue:
        entry = heappop(queue)
        rank, i = entry >> 32, entry & 0xFFFFFFFF
        if rank_at[i] != rank:
            continue  # stale: the pair is gone
        new = vocab.merged[rank]
        j = after[i]
        ids[i], ids[j], rank_at[j] = new, -1, -1
        after[i] = k = after[j]
        now = -1
        if k < n:
            before[k] = i
            now = ranks.get(new << 32 | ids[k], -1)
            if now >= 0:
                heappush(queue, now << 32 | i)
        rank_at[i] = now
        h = before[i]
        if h >= 0:
            rank_at[h] = now = ranks.get(ids[h] << 32 | new, -1)
            if now >= 0:
                heappush(queue, now << 32 | h)
    return [i for i in ids if i >= 0]


class Encoder:
    """Encodes and decodes whole texts. Pieces that come again are looked up."""

    def __init__(self, path: str):
        self.vocab = vocabulary(path)
        #: A piece's ids in decimals, and what they decode to.
        self._piece = Remembered(self._both)

    def _both(self, piece: str | int) -> tuple[str, str]:
        ids = [piece] if isinstance(piece, int) else merge(self.vocab.symbols(piece), self.vocab)
        return " ".join(map(str, ids)), self.decode(ids)

    def encode(self, text: str | None) -> list[int]:
        return [int(i) for i in self.decimals(text)[0].split()]

    def decode(self, ids: list[int]) -> str:
        strings = self.vocab.strings
        return " ".join([strings[i] for i in ids])

    def decimals(self, text: str | None) -> tuple[str, str]:
        """The ids as decimals joined by a space, and the text that they decode to."""
        found = self._piece.all(self.vocab.split(text or ""))
        return " ".join([a for a, _ in found]), " ".join([b for _, b in found])


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def encode_digests(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` for every row of ``docs``.

    The hashes are of the decimal ids joined by a space and of the decoded text. Null texts count
    as empty and have no ids; other columns are not read; repeated rows come back as often.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for batch in batches:
            n, ids_sha, text_sha = [], [], []
            for text in batch.column(1):
                ids, decoded = coder.decimals(text.as_py())
                n.append(ids.count(" ") + 1 if ids else 0)
                ids_sha.append(hashlib.sha256(ids.encode()).hexdigest())
                text_sha.append(hashlib.sha256(decoded.encode()).hexdigest())
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    ids = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {ids}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, schema)


def with_ids(docs: DataFrame, path: str, name: str = "ids") -> DataFrame:
    """``docs`` with an array column of the ids of ``text``."""

    @F.arrow_udf("array<int>")
    def column(texts: pa.Array) -> pa.Array:
        coder = encoder(path)
        # Numbers of four bytes: lists of Python's numbers would take ten times the space.
        found = [np.fromstring(coder.decimals(t.as_py())[0], np.int32, sep=" ") for t in texts]
        ends = np.cumsum([0, *map(len, found)], dtype=np.int32)
        return pa.ListArray.from_arrays(ends, np.concatenate([np.zeros(0, np.int32), *found]))

    return docs.withColumn(name, column(F.col("text").cast("string")))


def with_decoded(df: DataFrame, path: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """``df`` with the text that an array column of ids decodes to. Null decodes to null."""

    @F.pandas_udf("string")
    def column(arrays):
        return arrays.map(lambda a: None if a is None else encoder(path).decode([int(i) for i in a]))

    return df.withColumn(name, column(F.col(ids)))
