"""Language model scoring by a hashed maximum-entropy model with a class-factored softmax.

Every word belongs to a class: the most frequent words are classes of their own, the others share
classes by their last letters, which any word has, known or not. The probability of a word is
that of its class after the words before it, times that of the word in its class. The first factor is a
softmax over classes whose scores are sums of weights of features: the word before, the two words before,
the word before that (a skip), and the word before with the one two places further back (a skip pair), each
hashed into a table of a fixed number of rows. The second is the smoothed share of the word's count, so what is
counted, words over the whole training part, grows with the corpus.

Texts are read once and written as chunks of word numbers, each with its own list of words. Chunks and buckets of the
words' 64-bit hashes exchange packed lists (``blocks``): the counts in a chunk one way, those in all chunks the
other, so no count of the corpus is held in one place and no word is a hot key.
Training goes in rounds over disjoint parts of the chunks. In a round, every task takes gradient steps from the same
weights, and the changes of all tasks are averaged, row by row, by how often each task met the row. The table
of weights has a fixed size, whatever the corpus.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count, repeat

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outfall.llm import blocks
from outfall.llm.words import whole_text
from outfall.session import settle, shared_dir

#: Documents whose crc32 has this remainder are held out.
FOLDS, HELD_OUT = 7, 2
#: Words that are classes of their own, and the classes that the others share.
TOP_WORDS, SHARED_CLASSES = 64, 64
CLASSES = TOP_WORDS + SHARED_CLASSES
#: Rows of the table of weights for each kind of feature, as a power of two.
FEATURE_BITS = 12
KINDS = 4
#: Parts of the chunks that are trained on one after the other.
ROUNDS = 6
RATE = 1.0
MINIBATCH = 2048
#: Tokens whose scores are worked out together; they stay in the cache of a core.
SLICE = 256
#: Rows of a group up to which groups are summed side by side.
SMALL_GROUP = 12
#: Sums of powers between this and its reciprocal are safe in short floats.
LEAST = 1e-30
#: Bytes of text in a chunk; a longer text is a chunk of its own, or the last text of one.
CHUNK_BYTES = 4 * 1024 * 1024
#: Chunks that one task trains on about, and the fewest tasks where there are enough.
TASK_CHUNKS = 16
MIN_TASKS = 64
#: Rows of the table of weights that travel together.
BLOCK_ROWS = 256
#: The token after the last word of a text. No word is a space.
END = " "
_UPPER = bytes(range(65, 91))
_LOWER = bytes.maketrans(_UPPER, _UPPER.lower())
_SEED = 20_240_613
_START = np.uint64(0x243F6A8885A308D3)
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_LN10 = np.log(10.0)
#: Bytes of a word in a list: its hash, its count, and the class that it shares.
_ENTRY = 8 + 4 + 1


def chunks(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``docs`` as rows of word numbers, written down.

    A row has ``chunk``, the ``ids`` of its documents, whether they are ``held`` out, how many tokens each has
    (``lengths``), and, compressed, the ``tokens`` and the distinct ``words``; ``size`` is the number of these.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = count(TaskContext.get().partitionId() << 33)
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for doc_id, fold, text in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2), strict=True):
                held.append((doc_id, fold == HELD_OUT, text.as_py()))
                size += len(held[-1][-1])
                if size >= chunk_bytes:
                    yield _chunk(next(numbers), held)
                    held, size = [], 0
        if held:
            yield _chunk(next(numbers), held)

    rows = docs.select(
        "doc_id",
        (F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % FOLDS).cast("int").alias("fold"),
        whole_text(F.col("text")).cast("binary").alias("text"),
    )
    schema = f"chunk long, ids array<{id_type}>, held array<boolean>, lengths array<int>, tokens binary, words binary, size long"
    return settle(rows.mapInArrow(run, schema))


def _chunk(number: int, held: list[tuple]) -> pa.RecordBatch:
    known: dict[bytes, int] = defaultdict(count().__next__)
    known[END.encode()]  # the end is number 0
    tokens, lengths = [], []
    for _, _, text in held:
        words = text.translate(_LOWER).split()
        words.append(END.encode())
        tokens.append(np.fromiter(map(known.__getitem__, words), np.uint32, len(words)))
        lengths.append(len(words))
    pack = zstandard.ZstdCompressor(level=3).compress
    rows = [
        pa.array([number]),
        pa.ListArray.from_arrays([0, len(held)], pa.array([d.as_py() for d, _, _ in held], held[0][0].type)),
        pa.array([[out for _, out, _ in held]]),
        pa.array([lengths], pa.list_(pa.int32())),
        pa.array([pack(_planes(np.concatenate(tokens)))], pa.binary()),
        pa.array([pack(b"\n".join(known))], pa.binary()),
        pa.array([len(known)]),
    ]
    return pa.RecordBatch.from_arrays(rows, ["chunk", "ids", "held", "lengths", "tokens", "words", "size"])


def _planes(values: np.ndarray) -> bytes:
    """Numbers byte by byte, which compresses better."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.dtype.itemsize).T.tobytes()


def _from_planes(data: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _unpack(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


class _Ends(dict):
    """The shared class of the last letters of a word, hashed when they are first met."""

    def __missing__(self, end: bytes) -> int:
        self[end] = TOP_WORDS + xxhash.xxh64_intdigest(end, _SEED) % SHARED_CLASSES
        return self[end]


class Words:
    """The distinct words of a chunk: hashes, the classes that they share with others, and their order by hash."""

    def __init__(self, data: bytes):
        words = _unpack(data).split(b"\n")
        self.hashes = np.fromiter(map(xxhash.xxh64_intdigest, words, repeat(_SEED)), np.uint64, len(words))
        ends = _Ends()
        self.shared = np.array([ends[w[-2:] if w.isascii() else w.decode(errors="replace")[-2:].encode()] for w in words], np.int64)
        self.order = np.argsort(self.hashes)

    def classes(self, top: np.ndarray) -> np.ndarray:
        """The class of every word, given the hashes of those that are classes of their own, ascending."""
        if len(top) == 0:
            return self.shared
        at = np.minimum(np.searchsorted(top, self.hashes), len(top) - 1)
        return np.where(top[at] == self.hashes, at, self.shared)


def word_lists(rows: DataFrame, bits: int) -> DataFrame:
    """Of every chunk and bucket: hashes of its words in order, their counts in training texts, and their shared classes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, held, lengths, tokens, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = Words(data)
                trained = _from_planes(_unpack(tokens), np.uint32)[np.repeat(~np.asarray(held, bool), lengths)]
                counts = np.bincount(trained, minlength=len(words.hashes)).astype(np.uint32)[words.order]
                hashes, shared = words.hashes[words.order], words.shared[words.order].astype(np.uint8)
                found = []
                for bucket, part in blocks.runs((hashes >> np.uint64(64 - bits)).astype(np.int64)):
                    steps = np.diff(hashes[part], prepend=np.uint64(0))
                    found.append((bucket, _planes(steps) + _planes(counts[part]) + shared[part].tobytes()))
                arrays = [pa.array([b for b, _ in found], pa.int64()), pa.array([chunk] * len(found), pa.int64())]
                yield pa.RecordBatch.from_arrays([*arrays, pa.array([d for _, d in found], pa.binary())], ["bucket", "chunk", "listed"])

    return rows.select("chunk", "held", "lengths", "tokens", "words").mapInArrow(run, "bucket long, chunk long, listed binary")


def counted_words(lists: DataFrame) -> DataFrame:
    """What every bucket finds out, written down.

    For every chunk, in ``told``, the counts of its words in all training texts, in the order of their hashes. And
    once, with a null ``chunk``: the ``top`` words of the bucket, and the ``sums`` of its shared classes.
    """

    def run(table: pa.Table) -> pa.Table:
        hashes, counts, shared = [], [], []
        for data in table.column("listed").to_pylist():
            n = len(data) // _ENTRY
            hashes.append(np.cumsum(_from_planes(data[: 8 * n], np.uint64), dtype=np.uint64))
            counts.append(_from_planes(data[8 * n : 12 * n], np.uint32))
            shared.append(np.frombuffer(data[12 * n :], np.uint8))
        every, first, which = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
        c = np.bincount(which, weights=np.concatenate(counts)).astype(np.int64)
        cls = np.concatenate(shared)[first]
        most = np.lexsort((every, -c))[:TOP_WORDS]
        top = [{"hash": int(every[i].view(np.int64)), "c": int(c[i]), "cls": int(cls[i])} for i in most if c[i]]
        tokens, distinct = np.bincount(cls, weights=c, minlength=CLASSES), np.bincount(cls[c > 0], minlength=CLASSES)
        sums = [{"cls": int(k), "n": int(tokens[k]), "v": int(distinct[k])} for k in np.flatnonzero(distinct)]
        told = [_planes(p) for p in np.split(c[which], np.cumsum([len(h) for h in hashes])[:-1])]
        nothing = [None] * len(told)
        columns = [
            pa.array([*table.column("bucket").to_pylist(), None], pa.int64()),
            pa.array([*table.column("chunk").to_pylist(), None], pa.int64()),
            pa.array([*told, None], pa.binary()),
            pa.array([*nothing, top], top_kind),
            pa.array([*nothing, sums], sums_kind),
        ]
        return pa.Table.from_arrays(columns, ["bucket", "chunk", "told", "top", "sums"])

    top_kind = pa.list_(pa.struct([("hash", pa.int64()), ("c", pa.int64()), ("cls", pa.int32())]))
    sums_kind = pa.list_(pa.struct([("cls", pa.int32()), ("n", pa.int64()), ("v", pa.int64())]))
    schema = "bucket long, chunk long, told binary, top array<struct<hash:long,c:long,cls:int>>, sums array<struct<cls:int,n:long,v:long>>"
    return settle(lists.groupBy("bucket").applyInArrow(run, schema))


def first_model(found: DataFrame) -> Model:
    """The model before training: the most frequent words, and the sums of all classes."""
    once = found.filter(F.col("chunk").isNull())
    top = once.select(F.inline("top")).orderBy(F.desc("c"), "hash").limit(TOP_WORDS).collect()
    sums = once.select(F.inline("sums")).groupBy("cls").agg(F.sum("n").alias("n"), F.sum("v").alias("v"))
    held = {r["cls"]: [r["n"], r["v"]] for r in sums.collect()}  # a row per class
    for word in top:
        held[word["cls"]][0] -= word["c"]
        held[word["cls"]][1] -= 1
    hashes = np.sort(np.array([r["hash"] for r in top], np.int64).view(np.uint64))
    at = {h: i for i, h in enumerate(hashes.view(np.int64).tolist())}
    return Model({k: tuple(v) for k, v in held.items()} | {at[r["hash"]]: (r["c"], 1) for r in top}, hashes)


class Model:
    """Counts that the score of every word needs, and the weights, all of fixed size."""

    def __init__(self, sums: dict[int, tuple[int, int]], top: np.ndarray | None = None):
        #: Hashes of the words that are classes of their own, ascending.
        self.top = np.zeros(0, np.uint64) if top is None else top
        #: Of each class the tokens and distinct words in training texts.
        self.tokens = np.array([sums.get(k, (0, 0))[0] for k in range(CLASSES)], np.float64)
        self.words = np.array([sums.get(k, (0, 0))[1] for k in range(CLASSES)], np.float64)
        # Classes begin with the shares that they have, so that features learn what differs from them.
        start = np.log((self.tokens + 0.5) / (self.tokens.sum() + 0.5 * CLASSES))
        self.weights = np.zeros((1 + KINDS * (1 << FEATURE_BITS), CLASSES), np.float32)
        self.weights[0] = start
        #: Sums of squared gradients of each row.
        self.squares = np.full(len(self.weights), 1.0, np.float32)

    @property
    def n(self) -> float:
        return self.tokens.sum()

    @property
    def v(self) -> float:
        return self.words.sum()

    def in_class(self, c: np.ndarray, cls: np.ndarray) -> np.ndarray:
        """Log probability of a word with count ``c`` in its class. A word of a class of its own is certain."""
        shared = np.log((c + 1) / (self.tokens[cls] + self.words[cls] + 1))
        return np.where((cls < TOP_WORDS) & (c > 0), 0.0, shared)

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 1) / (self.n + self.v + 1))


def features(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Rows of the weights for every token: one of each kind of feature, next to the first row."""

    def back(values: np.ndarray) -> np.ndarray:
        moved = np.empty_like(values)
        moved[1:] = values[:-1]
        moved[starts] = _START
        return moved

    one = back(hashes)
    two = back(one)
    three = back(two)
    kinds = [one, _mixed(two) + one, two, _mixed(three + np.uint64(1)) + one]
    shift = np.uint64(64 - FEATURE_BITS)
    found = np.empty((len(hashes), KINDS), np.int32)
    for k, kind in enumerate(kinds):
        found[:, k] = 1 + (k << FEATURE_BITS) + (_mixed(kind + np.uint64(k)) >> shift).astype(np.int32)
    return found


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) * _MULTIPLIER


def class_scores(weights: np.ndarray, rows: np.ndarray, out: np.ndarray | None = None, more: np.ndarray | None = None) -> np.ndarray:
    """Log probabilities of all classes, up to a constant for each token that is subtracted in place.

    ``out`` and ``more`` are room for as many rows, if there is some already.
    """
    found = np.empty((len(rows), weights.shape[1]), weights.dtype) if out is None else out
    other = np.empty_like(found) if more is None else more
    # Rows exist, so there is nothing to clip, but numpy then copies them without a buffer.
    np.take(weights, rows[:, 0], axis=0, out=found, mode="clip")
    for k in range(1, rows.shape[1]):
        np.take(weights, rows[:, k], axis=0, out=other, mode="clip")
        found += other
    found += weights[0]
    # Halves are compared side by side: faster than numpy's maximum of a row.
    most = found
    while most.shape[1] > 1 and most.shape[1] % 2 == 0:
        half = most.shape[1] // 2
        most = np.maximum(most[:, :half], most[:, half:])
    found -= most.max(axis=1, keepdims=True)
    return found


class Powers:
    """Powers of e by the weights, each row up to a factor of its own: shares of classes are products of rows."""

    def __init__(self, weights: np.ndarray):
        self.weights = weights
        table = weights.copy()
        table[1 : 1 + (1 << FEATURE_BITS)] += weights[0]  # every token has one row of the first kind
        table -= table.max(axis=1, keepdims=True)
        self.table = np.exp(table, out=table)


def own_scores(weights: np.ndarray | Powers, rows: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """The log probability of every token's class."""
    powers = weights if isinstance(weights, Powers) else Powers(weights)
    table = powers.table
    own, total = np.empty((2, len(labels)), np.float64)
    room = np.empty((2, SLICE, CLASSES), table.dtype)
    numbers = np.arange(SLICE)
    for at in range(0, len(labels), SLICE):
        y = labels[at : at + SLICE]
        i = numbers[: len(y)]
        found, other = room[:, : len(y)]
        kinds = rows[at : at + SLICE].T
        np.take(table, kinds[0], axis=0, out=found, mode="clip")
        for kind in kinds[1:-1]:
            np.take(table, kind, axis=0, out=other, mode="clip")
            found *= other
        np.take(table, kinds[-1], axis=0, out=other, mode="clip")
        np.multiply(found[i, y], other[i, y], out=own[at : at + SLICE])
        total[at : at + SLICE] = np.einsum("ij,ij->i", found, other)
    # Where the rows disagree so much that short floats do not hold the products, scores are summed instead.
    far = np.flatnonzero(~((own > LEAST) & (total > LEAST)))
    with np.errstate(divide="ignore", invalid="ignore"):
        logs = np.log(own / total)
    for at in range(0, len(far), SLICE):
        part = far[at : at + SLICE]
        scores = class_scores(powers.weights, rows[part]).astype(np.float64)
        logs[part] = scores[np.arange(len(part)), labels[part]] - np.log(np.exp(scores).sum(axis=1))
    return logs


class Chunk:
    """One row of chunks with what is known of its words."""

    def __init__(self, lengths: np.ndarray, held: np.ndarray, tokens: bytes, words: bytes, counts: bytes, top: np.ndarray):
        known = Words(words)
        self.tokens = _from_planes(_unpack(tokens), np.uint32)
        self.lengths, self.held = np.asarray(lengths, np.int64), np.asarray(held, bool)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.c = np.empty(len(known.hashes), np.int64)
        self.c[known.order] = _from_planes(_unpack(counts), np.int64)
        self.cls = known.classes(top)
        self.rows = features(known.hashes[self.tokens], self.starts)


def _chunks(batches: Iterator[pa.RecordBatch], top: np.ndarray) -> Iterator[tuple[Chunk, pa.Array]]:
    for batch in batches:
        for i in range(batch.num_rows):
            one = {name: batch.column(name).slice(i, 1) for name in batch.schema.names}
            lists = [one[name].flatten().to_numpy(zero_copy_only=False) for name in ("lengths", "held")]
            data = [one[name][0].as_py() for name in ("tokens", "words", "known")]
            yield Chunk(*lists, *data, top), one["ids"].flatten()


def train(model: Model, chunk: Chunk, met: np.ndarray, rate: float) -> None:
    """Gradient steps over the training tokens of a chunk, in a fixed random order."""
    trained = np.flatnonzero(np.repeat(~chunk.held, chunk.lengths))
    np.random.default_rng(len(trained)).shuffle(trained)
    labels = chunk.cls[chunk.tokens[trained]]
    room = np.empty((MINIBATCH, CLASSES), model.weights.dtype)
    for at in range(0, len(trained), MINIBATCH):
        rows, y = chunk.rows[trained[at : at + MINIBATCH]], labels[at : at + MINIBATCH]
        gradient = room[: len(y)]
        lengths = _gradient(model.weights, rows, y, gradient)
        whole = gradient.sum(axis=0, keepdims=True)
        _step(model, met, np.zeros(1, np.int64), whole, np.einsum("ij,ij->i", whole, whole), np.array([len(y)]), rate)
        # Rows of the kinds follow each other, and are short numbers without the first, which are sorted by their digits.
        short = (rows.T - 1).astype(np.uint16).ravel()
        order = np.argsort(short, kind="stable")
        ranked = short[order]
        first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
        n = np.diff(first, append=len(ranked))
        order %= len(y)  # the token of every place
        largest = np.argsort((len(y) - n).astype(np.uint16), kind="stable")
        first, n = first[largest], n[largest]
        touched = ranked[first].astype(np.int64) + 1
        alone = int(np.searchsorted(-n, -1))
        sums = _sums(gradient, order, first[:alone], n[:alone])
        _step(model, met, touched[:alone], sums, np.einsum("ij,ij->i", sums, sums), n[:alone], rate)
        # Most rows are met by one token, whose gradient is the sum.
        tokens = order[first[alone:]]
        _step(model, met, touched[alone:], gradient, lengths[tokens], n[alone:], rate, tokens)


def _gradient(weights: np.ndarray, rows: np.ndarray, labels: np.ndarray, out: np.ndarray) -> np.ndarray:
    """Write the gradient of every token's scores to ``out``, and return the sums of their squares."""
    lengths = np.empty(len(labels), out.dtype)
    more = np.empty((SLICE, CLASSES), out.dtype)
    numbers = np.arange(SLICE)
    for at in range(0, len(labels), SLICE):
        part, y = out[at : at + SLICE], labels[at : at + SLICE]
        other, kinds = more[: len(part)], rows[at : at + SLICE].T
        np.take(weights, kinds[0], axis=0, out=part, mode="clip")
        for kind in kinds[1:]:
            np.take(weights, kind, axis=0, out=other, mode="clip")
            part += other
        part += weights[0]
        with np.errstate(over="ignore", invalid="ignore"):
            total = np.exp(part, out=part).sum(axis=1)
        if not (total.min() > LEAST and total.max() < 1 / LEAST):
            # Short floats do not hold the powers unless the largest is made 1.
            class_scores(weights, rows[at : at + SLICE], part, other)
            total = np.exp(part, out=part).sum(axis=1)
        part *= (1 / total)[:, None]
        part[numbers[: len(y)], y] -= 1
        lengths[at : at + SLICE] = np.einsum("ij,ij->i", part, part)
    return lengths


def _step(
    model: Model, met: np.ndarray, touched: np.ndarray, sums: np.ndarray, squares: np.ndarray, n: np.ndarray, rate: float,
    places: np.ndarray | None = None,
) -> None:
    """Change the rows ``touched``, each there once, by the ``sums`` of the gradients of ``n`` tokens.

    ``squares`` are the sums of their squares; ``places`` says where in ``sums`` a row's is, if not at its own place.
    """
    met[touched] += n
    squares = model.squares[touched] + squares
    model.squares[touched] = squares
    factors = (rate / np.sqrt(squares))[:, None]
    room = np.empty((2, min(SLICE, len(touched)), sums.shape[1]), sums.dtype)
    for at in range(0, len(touched), SLICE):
        some = touched[at : at + SLICE]
        change, weights = room[:, : len(some)]
        if places is None:
            np.multiply(sums[at : at + SLICE], factors[at : at + SLICE], out=change)
        else:
            np.take(sums, places[at : at + SLICE], axis=0, out=change, mode="clip")
            change *= factors[at : at + SLICE]
        np.take(model.weights, some, axis=0, out=weights, mode="clip")
        weights -= change
        model.weights[some] = weights


def _sums(values: np.ndarray, order: np.ndarray, first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Sums of the rows of ``values`` in groups, the largest first: ``n`` of them, from place ``first`` on in ``order``.

    The few large groups are summed one by one, the many small ones side by side; numpy's own way of summing
    groups of rows takes several times as long.
    """
    sums = values.take(order[first], axis=0)
    large = int(np.searchsorted(-n, -SMALL_GROUP))
    for g, (at, size) in enumerate(zip(first[:large].tolist(), n[:large].tolist(), strict=True)):
        np.add.reduce(values.take(order[at : at + size], axis=0), axis=0, out=sums[g])
    for k in range(1, SMALL_GROUP):
        end = int(np.searchsorted(-n, -k))
        if end <= large:
            break
        sums[large:end] += values.take(order[first[large:end] + k], axis=0)
    return sums


def _changes(before: Model, after: Model, met: np.ndarray) -> pa.RecordBatch:
    """Of every row that was met: how often, and the changes of its squares and, in short floats, of its weights."""
    places, data = [], []
    for block in range(0, len(met), BLOCK_ROWS):
        part = slice(block, block + BLOCK_ROWS)
        if met[part].any():
            change = (after.weights - before.weights)[part].astype(np.float16)
            squares = (after.squares - before.squares)[part].astype(np.float32)
            places.append(block)
            data.append(met[part].astype(np.float64).tobytes() + squares.tobytes() + change.tobytes())
    return pa.RecordBatch.from_arrays([pa.array(places, pa.int64()), pa.array(data, pa.binary())], ["block", "change"])


def _weighted(change: bytes) -> np.ndarray:
    """What tasks are added up by: of each row the changes of weights and squares times how often it was met, and that."""
    rows = len(change) // (8 + 4 + 2 * CLASSES)
    met = np.frombuffer(change[: 8 * rows], np.float64)[:, None]
    squares = np.frombuffer(change[8 * rows : 12 * rows], np.float32)[:, None]
    weights = np.frombuffer(change[12 * rows :], np.float16).reshape(rows, CLASSES)
    return np.hstack([weights * met, squares * met, met])


_CHANGES = "block long, change binary"


def _copied(model: Model) -> Model:
    copy = Model.__new__(Model)
    copy.__dict__ = {k: v.copy() for k, v in model.__dict__.items()}
    return copy


def round_of_training(rows: DataFrame, model: Model, rate: float = RATE) -> Model:
    """The model after all tasks took their steps from it."""
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = sent.value
        after, met = _copied(before), np.zeros(len(before.squares), np.float64)
        for chunk, _ in _chunks(batches, before.top):
            train(after, chunk, met, rate)
        yield _changes(before, after, met)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, change in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                values = _weighted(change.as_py())
                sums[block] = sums[block] + values if block in sums else values
        places = pa.array(list(sums), pa.int64())
        yield pa.RecordBatch.from_arrays([places, pa.array([s.tobytes() for s in sums.values()], pa.binary())], ["block", "change"])

    changes = rows.mapInArrow(steps, _CHANGES).repartition("block").mapInArrow(add, _CHANGES)
    after = _copied(model)
    # One row per block of the table, which has a fixed size.
    for block, change in changes.toLocalIterator():
        summed = np.frombuffer(change, np.float64).reshape(-1, CLASSES + 2)
        part = slice(block, block + len(summed))
        mean = summed[:, :-1] / np.maximum(summed[:, -1:], 1)
        after.weights[part] += mean[:, :-1].astype(np.float32)
        after.squares[part] += mean[:, -1].astype(np.float32)
    sent.unpersist()
    return after


def with_known(rows: DataFrame, found: DataFrame, rounds: int) -> DataFrame:
    """Chunks with the counts of their words (``known``), written down by ``round``."""
    n = rows.count()
    tasks = max(1, min(n, MIN_TASKS), n // TASK_CHUNKS)

    def run(chunk: pa.Table, told: pa.Table) -> pa.Table:
        parts = told.column("told").to_pylist()
        order = np.argsort(told.column("bucket").to_numpy())
        counts = np.concatenate([np.zeros(0, np.int64), *(_from_planes(parts[i], np.int64) for i in order)])
        known = zstandard.ZstdCompressor(level=3).compress(_planes(counts))
        return chunk.append_column("known", pa.array([known] * chunk.num_rows, pa.binary()))

    told = found.filter(F.col("chunk").isNotNull()).select("chunk", "bucket", "told").repartition(tasks, "chunk")
    rows = rows.drop("size")
    schema = T.StructType([*rows.schema.fields, T.StructField("known", T.BinaryType())])
    dealt = rows.repartition(tasks, "chunk")
    joined = dealt.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(run, schema)
    joined = joined.withColumn("round", F.pmod(F.xxhash64("chunk"), F.lit(rounds)))
    path = shared_dir(rows.sparkSession)
    joined.write.partitionBy("round").parquet(path)
    return rows.sparkSession.read.schema(joined.schema).parquet(path)


def fitted(rows: DataFrame, rounds: int = ROUNDS, rate: float = RATE) -> tuple[DataFrame, Model]:
    """The chunks with what is known of their words, and the model trained on them."""
    bits = blocks.bucket_bits(rows.agg(F.sum("size")).first()[0] or 0)
    found = counted_words(word_lists(rows, bits))
    model = first_model(found)
    encoded = with_known(rows, found, rounds)
    if model.n:
        for i in range(rounds):
            model = round_of_training(encoded.filter(F.col("round") == i), model, rate)
    return encoded, model


def language_model_scores(
    docs: DataFrame, chunk_bytes: int = CHUNK_BYTES, rounds: int = ROUNDS, rate: float = RATE
) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``): its log probability, in base 10.

    Returns ``doc_id``, ``held_out``, ``n_tokens`` (with the end), ``n_known`` (tokens that training texts have),
    ``train_tokens``, ``base_score`` (unigrams with one added to every count) and ``score``. Null texts are empty and have the
    end alone; a null id counts as an empty one in the choice of what is held out; other columns are not read;
    repeated rows come back, and are learnt, as often as they are there. Without training texts, no word
    is known and all classes are alike.
    """
    rows = chunks(docs, chunk_bytes)
    encoded, model = fitted(rows, rounds, rate)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        powers = Powers(model.weights)
        for chunk, ids in _chunks(batches, model.top):
            c, cls = chunk.c.astype(np.float64), chunk.cls
            total = np.add.reduceat
            logs = model.in_class(c, cls)[chunk.tokens]
            logs += own_scores(powers, chunk.rows, cls[chunk.tokens])
            columns = [
                ids, pa.array(chunk.held), pa.array(chunk.lengths),
                pa.array(total((c > 0)[chunk.tokens].astype(np.int64), chunk.starts)),
                pa.array(np.full(len(ids), int(model.n))),
                pa.array(total(model.base(c)[chunk.tokens], chunk.starts)),
                pa.array(total(logs, chunk.starts) / _LN10),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    schema = f"doc_id {id_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return encoded.drop("round").mapInArrow(run, schema)
