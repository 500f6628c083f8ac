"""Token ids in binary segments whose document boundaries are Elias-Fano encoded.

A segment is one binary value: a header, the ids of its documents one after the other in 16 or 32
bits, and two Elias-Fano sequences, the boundaries between documents and the document ids.
Segments are rows of a Parquet table, so that Spark's own writers commit them, to any store and
also when an executor is lost. A segment's place in the whole is its number; where its ids begin
is the sum of the ids of the segments before it.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from outfall.llm.vocabulary import Remembered, vocabulary

#: Ids after which a segment ends, at the next end of a document.
SEGMENT_IDS = 2_000_000
#: Every so many ones of the upper bits, the place of the one is kept.
SAMPLE = 256
#: Pieces remembered in each of two generations; their ids take little room.
CACHED = 300_000
_FOREIGN = re.compile("[^\x00-\u024f]")
_MAGIC = b"OFTS"
_HEAD = struct.Struct("<4sHHQQQq")
_EF_HEAD = struct.Struct("<QBQ")


class EliasFano:
    """A non-decreasing sequence of numbers from 0 on, in about 2 + log2(largest / length) bits each."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bits = max(0, (top // max(n, 1)).bit_length() - 1)
        ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        bits[ones] = 1
        shifts = np.arange(low_bits, dtype=np.uint64)
        lows = ((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8) if low_bits else np.zeros((n, 0), np.uint8)
        return cls(n, low_bits, np.packbits(lows.ravel()), np.packbits(bits), ones[::SAMPLE].astype(np.uint32))

    def to_bytes(self) -> bytes:
        head = _EF_HEAD.pack(self.n, self.low_bits, len(self.high))
        return head + self.samples.tobytes() + self.high.tobytes() + self.low.tobytes()

    @classmethod
    def from_bytes(cls, data: memoryview) -> tuple[EliasFano, memoryview]:
        """The sequence at the start of ``data``, and what follows it."""
        n, low_bits, n_high = _EF_HEAD.unpack_from(data)
        sizes = [4 * -(-n // SAMPLE), n_high, -(-n * low_bits // 8)]
        parts, at = [], _EF_HEAD.size
        for size in sizes:
            parts.append(data[at : at + size])
            at += size
        samples = np.frombuffer(parts[0], np.uint32)
        return cls(n, low_bits, np.frombuffer(parts[2], np.uint8), np.frombuffer(parts[1], np.uint8), samples), data[at:]

    def _low(self, i: int) -> int:
        value = 0
        for k in range(self.low_bits):
            at = i * self.low_bits + k
            value |= int(self.low[at >> 3] >> (7 - (at & 7)) & 1) << k
        return value

    def select(self, i: int) -> int:
        """The i-th number. Reads the upper bits from the nearest sample on."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at, left = int(self.samples[i // SAMPLE]), i % SAMPLE
        byte = at >> 3
        window = np.unpackbits(self.high[byte : byte + 64])
        ones = np.flatnonzero(window[at & 7 :]) + (at & 7)
        while len(ones) <= left:
            left -= len(ones)
            byte += 64
            ones = np.flatnonzero(np.unpackbits(self.high[byte : byte + 64]))
        place = (byte << 3) + int(ones[left])
        return (place - i) << self.low_bits | self._low(i)

    def values(self) -> np.ndarray:
        """All numbers, as unsigned 64-bit ones."""
        ones = np.flatnonzero(np.unpackbits(self.high))[: self.n] - np.arange(self.n)
        result = ones.astype(np.uint64) << np.uint64(self.low_bits)
        bits = np.unpackbits(self.low)[: self.n * self.low_bits].reshape(self.n, self.low_bits)
        for k in range(self.low_bits):
            result |= bits[:, k].astype(np.uint64) << np.uint64(k)
        return result


def pack_segment(doc_ids: list[int | None], arrays: list[bytes], width: int) -> bytes:
    """One segment. ``arrays`` are little-endian ids of ``width`` bytes; null ids come first."""
    ends = np.cumsum([0] + [len(a) // width for a in arrays])
    named = [i for i in doc_ids if i is not None]
    least = named[0] if named else 0
    head = _HEAD.pack(_MAGIC, 1, width, len(arrays), int(ends[-1]), len(doc_ids) - len(named), least)
    names = EliasFano.of(np.array([i - least for i in named], np.uint64))
    return b"".join([head, EliasFano.of(ends).to_bytes(), names.to_bytes(), *arrays])


class Segment:
    """A segment that was read: ``doc_ids``, and the ids of any document by its place."""

    def __init__(self, blob: bytes):
        data = memoryview(blob)
        magic, version, self.width, self.n_docs, self.n_ids, nulls, least = _HEAD.unpack_from(data)
        if magic != _MAGIC or version != 1:
            raise ValueError("not a token segment")
        self.ends, data = EliasFano.from_bytes(data[_HEAD.size :])
        names, data = EliasFano.from_bytes(data)
        self.doc_ids = [None] * nulls + [least + int(v) for v in names.values()]
        self.ids = np.frombuffer(data, np.uint16 if self.width == 2 else np.uint32, self.n_ids)

    def document(self, place: int) -> np.ndarray:
        return self.ids[self.ends.select(place) : self.ends.select(place + 1)]

    def bounds(self) -> np.ndarray:
        return self.ends.values().astype(np.int64)


class LibraryEncoder:
    """Ids by the tokenizers library, which is asked once for each piece that is not remembered."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.vocab = vocabulary(path)
        size = max(max(self.vocab.ids.values()), *self.vocab.special.values()) + 1
        self.width = 2 if size <= 1 << 16 else 4
        self.dtype = np.uint16 if self.width == 2 else np.uint32
        self._piece = Remembered(self._piece_ids, CACHED)

    def _packed(self, ids: list[int]) -> bytes:
        return np.array(ids, self.dtype).tobytes()

    def _piece_ids(self, piece: str | int) -> bytes:
        if isinstance(piece, int):
            return self._packed([piece])
        return self._packed([t.id for t in self.model.tokenize(self.vocab.symbols(piece))])

    def encode(self, text: str | None) -> bytes:
        text = text or ""
        if text.isascii() or not _FOREIGN.search(text):
            return b"".join(self._piece.all(self.vocab.split(text)))
        # Composition, case and character classes of other scripts are left to the library.
        return b"".join([self._foreign(w) if _FOREIGN.search(w) else self.encode(w) for w in _words(text)])

    def _foreign(self, word: str) -> bytes:
        return self._packed(self.tokenizer.encode(word, add_special_tokens=False).ids)


def _words(text: str) -> list[str]:
    return [w.decode() for w in text.encode().split()]


@lru_cache(maxsize=2)
def library_encoder(path: str) -> LibraryEncoder:
    return LibraryEncoder(path)


def write_tokens(docs: DataFrame, path: str, to: str, end_id: int, segment_ids: int = SEGMENT_IDS) -> None:
    """Encode ``docs`` (``doc_id``, ``text``) in ascending order of ``doc_id`` to segments at ``to``.

    Each document gets ``end_id`` as its last id. Null texts are empty; rows with a null id come
    first; rows with the same id are in the order of a hash of their texts. An empty table gives no segment.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = library_encoder(path)
        end = np.array([end_id], coder.dtype).tobytes()
        part, number = TaskContext.get().partitionId(), 0
        names: list[int | None] = []
        arrays: list[bytes] = []
        size = 0

        def flush() -> pa.RecordBatch:
            blob = pack_segment(names, arrays, coder.width)
            row = {"part": [part], "number": [number], "n_docs": [len(names)], "n_ids": [size // coder.width], "segment": [blob]}
            return pa.RecordBatch.from_pydict(row, schema)

        for batch in batches:
            for name, text in zip(batch.column(0), batch.column(1), strict=True):
                names.append(name.as_py())
                arrays.append(coder.encode(text.as_py()) + end)
                size += len(arrays[-1])
                if size >= segment_ids * coder.width:
                    yield flush()
                    names, arrays, size, number = [], [], 0, number + 1
        if names:
            yield flush()

    fields = [("part", pa.int32()), ("number", pa.int32()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]
    schema = pa.schema([*fields, ("segment", pa.binary())])
    (
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
        .withColumn("_tie", F.xxhash64("text"))
        .repartitionByRange("doc_id", "_tie")
        .sortWithinPartitions("doc_id", "_tie")
        .select("doc_id", "text")
        .mapInArrow(run, "part int, number int, n_docs long, n_ids long, segment binary")
        .write.mode("overwrite")
        .option("compression", "none")
        .parquet(to)
    )


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """The segments at ``path`` with ``start``, the number of ids in all segments before each."""
    segments = spark.read.parquet(path)
    sizes = segments.select("part", "number", "n_ids")
    # Two steps, so that the window over everything has one row per written partition.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        sizes.groupBy("part").agg(F.sum("n_ids").alias("_n"))
        .select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    )
    inside = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("_in", F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).join(parts, "part")
    places = starts.select("part", "number", (F.col("_base") + F.col("_in")).cast("long").alias("start"))
    return segments.join(F.broadcast(places), ["part", "number"])  # one row per SEGMENT_IDS ids


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens`` and ``ids_crc32`` (of the ids as 32-bit numbers) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, blob in zip(batch.column(0), batch.column(1), strict=True):
                segment = Segment(blob.as_py())
                bounds = segment.bounds()
                wide = segment.ids.astype("<u4").tobytes()
                crcs = [zlib.crc32(wide[4 * a : 4 * b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                columns = [
                    pa.array(segment.doc_ids, pa.int64()),
                    pa.array(start.as_py() + bounds[:-1]),
                    pa.array(np.diff(bounds)),
                    pa.array(crcs, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32"])

    segments = read_segments(spark, path).select("start", "segment")
    return segments.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
