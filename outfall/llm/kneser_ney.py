"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model of trusted text.

The model is over trigrams of characters. Every character of the corpus is a symbol of its own, and so
are the ends of a text; the trigrams are rows of a table that grows with the corpus. They are joined
with the sums of their contexts, of their shorter grams and of the contexts of these.

Scoring is a sharded join: a document is its distinct trigrams with their counts, cut into
shards by the trigram, and each shard meets the same shard of the model. Documents lie in blocks,
each of which gets a copy of the model's shard. The shards grow in number with the model, and the blocks
in size, so that neither a task's share nor the copies for each document grow with the corpus. Log
probabilities are whole millionths, so that sums do not depend on their order.

A document is rejected when its cross entropy is above a high quantile of that of the trusted
documents of its language. Trusted documents are held out: the trusted texts fall into two halves by a
hash of the text, and the entropy of each is that under the model of the other half. Short texts are drawn
towards the mean: their entropy is that of the text and of ``PRIOR_CHARS`` average characters of trusted
text, held out as well. Texts without characters are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from outfall.llm.words import BROADCAST_ROWS, carried, restored, small, whole_text
from outfall.session import settle

#: All symbols that there may be: the code points, and the ends of a text. 21 bits each in ``code``.
SYMBOLS = 0x110000 + 1
_BITS = 21
_END = 0
#: Trigrams in a shard of the model, about, and the fewest shards; documents in a block, for each shard of these.
SHARD_GRAMS = 100_000
LEAST_SHARDS = 9
BLOCK_DOCS = 8_000
#: Characters handled at once, and documents; what a Python worker holds beside its batch follows from them.
SLICE_CHARS, SLICE_DOCS = 400_000, 2_000
#: Counts that a task holds before it passes them on.
HELD_COUNTS = 2_000_000
UNIT = 1_000_000
QUANTILE = 0.99
PRIOR_CHARS = 100
#: Parts of the trusted texts, each held out once.
FOLDS = 2
#: Trusted documents that a language needs for a threshold of its own.
LEAST_TRUSTED = 50
_BIN = 0.001


def alphabet(docs: DataFrame) -> list[int]:
    """All code points of the texts, the most frequent first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0x110000, np.int64)
        for batch in batches:
            for text in batch.column(0):
                found = np.bincount(_code_points(text.as_py() or ""))
                total[: len(found)] += found
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["point", "n"])

    counts = docs.select(F.col("text").cast("string")).mapInArrow(run, "point long, n long")
    top = counts.groupBy("point").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "point")
    return [row["point"] for row in top.collect()]


def _code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


class Grams:
    """The trigrams of texts, as numbers of three symbols of ``bits`` bits: those that the alphabet needs."""

    def __init__(self, points: list[int]):
        self.symbol = np.zeros(0x110000, np.uint64)
        self.symbol[points] = np.arange(len(points), dtype=np.uint64) + np.uint64(1)
        self.bits = symbol_bits(points)
        #: Documents whose place fits beside a trigram in 64 bits.
        self.most_docs = min(SLICE_DOCS, 1 << 64 - 3 * self.bits)

    def of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The text and the trigram of every character, and of every text's end."""
        sizes = np.array([len(t) + 3 for t in texts], np.int64)
        ends = np.cumsum(sizes)
        place = np.ones(int(sizes.sum()), bool)
        for padding in (ends - sizes, ends - sizes + 1, ends - 1):  # two before a text, one after
            place[padding] = False
        padded = np.full(len(place), _END, np.uint64)
        padded[place] = self.symbol[_code_points("".join(texts))]
        codes = _packed(padded[:-2], padded[1:-1], padded[2:], self.bits)
        # The two places that begin in one text and end in the next are left out.
        text = np.repeat(np.arange(len(texts), dtype=np.uint32), sizes)
        inside = text[:-2] == text[2:]
        return text[:-2][inside], codes[inside]

    def wide(self, codes: np.ndarray) -> np.ndarray:
        """``gram_code`` of the trigrams."""
        bits, mask = np.uint64(self.bits), np.uint64((1 << self.bits) - 1)
        return gram_code(codes >> bits + bits, codes >> bits & mask, codes & mask).astype(np.int64)


def symbol_bits(points: list[int]) -> int:
    return max(1, len(points).bit_length())


def _packed(first, second, third, bits: int):
    if isinstance(first, np.ndarray):
        bits = np.uint64(bits)
    return first << bits + bits | second << bits | third


def gram_code(first, second, third):
    """The three symbols in one number, whatever the alphabet."""
    return _packed(first, second, third, _BITS)


def _slices(column: pa.Array, most_docs: int = SLICE_DOCS) -> Iterator[tuple[int, list[str]]]:
    """The place of each slice's first text, and its texts; only one slice is decoded at a time."""
    begin, size, texts = 0, 0, []
    for text in column:
        text = text.as_py() or ""
        if texts and (size + len(text) > SLICE_CHARS or len(texts) >= most_docs):
            yield begin, texts
            begin, size, texts = begin + len(texts), 0, []
        size += len(text)
        texts.append(text)
    if texts:
        yield begin, texts


class Tally:
    """Sums of counts by code, over as many codes as there are."""

    def __init__(self):
        self.parts, self.size = [], 0

    def add(self, codes: np.ndarray) -> None:
        if len(codes):
            self.parts.append(np.unique(codes, return_counts=True))
            self.size += len(self.parts[-1][0])

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        if len(self.parts) > 1:
            codes, counts = (np.concatenate(p) for p in zip(*self.parts, strict=True))
            order = np.argsort(codes, kind="stable")
            codes, counts = codes[order], counts[order]
            starts = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
            self.parts = [(codes[starts], np.add.reduceat(counts, starts))]
            self.size = len(starts)
        return self.parts[0] if self.parts else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def gram_counts(flagged: DataFrame, points: list[int]) -> DataFrame:
    """``code``, and how often in all texts (``n``), in trusted ones and in each fold of these (``trusted_0``...).

    A task passes on partial sums: what it has counted by its end, or when it holds too many codes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, tallies = Grams(points), {fold: Tally() for fold in range(-1, FOLDS)}

        def out(fold: int) -> pa.RecordBatch:
            codes, counts = tallies[fold].merge()
            tallies[fold] = Tally()
            columns = [pa.array(grams.wide(codes)), pa.array(np.full(len(codes), fold, np.int32)), pa.array(counts)]
            return pa.RecordBatch.from_arrays(columns, ["code", "fold", "n"])

        for batch in batches:
            folds = np.array(batch.column(1).to_pylist(), np.int32)
            for begin, texts in _slices(batch.column(0)):
                doc, codes = grams.of(texts)
                at = folds[begin + doc]
                for fold, tally in tallies.items():
                    tally.add(codes[at == fold])
                    if tally.size > HELD_COUNTS:
                        tally.merge()
                        if tally.size > HELD_COUNTS // 2:
                            yield out(fold)
        for fold in tallies:
            yield out(fold)

    rows = flagged.select("text", "fold").mapInArrow(run, "code long, fold int, n long")
    held = [("trusted", F.col("fold") >= 0), *[(f"trusted_{i}", F.col("fold") == i) for i in range(FOLDS)]]
    return rows.groupBy("code").agg(F.sum("n").alias("n"), *[F.sum(F.when(c, F.col("n")).otherwise(0)).alias(name) for name, c in held])


def held_out(counts: DataFrame) -> DataFrame:
    """``code``, its ``cost``, and ``cost_0``... under the models that lack a fold of the trusted texts.

    Where trusted text is in one fold only, there is nothing else to learn from, so nothing is held out.
    """
    counts = settle(counts)
    sums = counts.agg(F.sum("trusted"), *[F.sum(f"trusted_{i}") for i in range(FOLDS)]).first()
    model = settle(log_probabilities(counts))
    for i in range(FOLDS):
        if sums[0] and sums[0] > sums[i + 1]:
            rest = counts.select("code", "n", (F.col("trusted") - F.col(f"trusted_{i}")).alias("trusted"))
            model = model.join(settle(log_probabilities(rest)).withColumnRenamed("cost", f"cost_{i}"), "code")
        else:
            model = model.withColumn(f"cost_{i}", F.col("cost"))
    return settle(model)


def _discounts(counts: DataFrame, name: str) -> list[float]:
    """The three discounts of the counts in column ``name``, from how many grams occur 1 to 4 times."""
    have = counts.filter(F.col(name).between(1, 4)).groupBy(name).count().collect()  # four rows
    n = {row[0]: row[1] for row in have}
    n1, n2, n3, n4 = (n.get(i, 0) for i in (1, 2, 3, 4))
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    raw = [1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return [min(max(d, 0.05), i + 0.95) for i, d in enumerate(raw)]


def _discount(count: Column, by: list[float]) -> Column:
    return F.when(count == 1, by[0]).when(count == 2, by[1]).when(count >= 3, by[2]).otherwise(0.0)


def log_probabilities(counts: DataFrame) -> DataFrame:
    """``code`` and ``cost``, the negative log probability of its last symbol, in millionths.

    ``counts`` is the result of ``gram_counts``; every trigram in it gets a cost, whether trusted
    text has it or not. Without trusted text all symbols are equally likely.
    """
    mask = F.lit((1 << _BITS) - 1)
    grams = settle(
        counts.select(
            "code",
            F.shiftright("code", 2 * _BITS).alias("a"),
            F.shiftright("code", _BITS).bitwiseAND(mask).alias("b"),
            F.col("code").bitwiseAND(mask).alias("c"),
            F.col("trusted").alias("c3"),
        )
    )
    seen = grams.filter("c3 > 0")
    pairs = settle(seen.groupBy("b", "c").agg(F.count(F.lit(1)).alias("c2")))
    singles = settle(pairs.groupBy("c").agg(F.count(F.lit(1)).alias("c1")))
    d3, d2, d1 = _discounts(seen, "c3"), _discounts(pairs, "c2"), _discounts(singles, "c1")

    def contexts(table: DataFrame, by: list[str], count: str, discounts: list[float], level: int) -> DataFrame:
        total, held = F.sum(count), F.sum(_discount(F.col(count), discounts))
        return table.groupBy(*by).agg(total.alias(f"t{level}"), (held / total).alias(f"g{level}"))

    all_singles = contexts(singles.withColumn("k", F.lit(0)), ["k"], "c1", d1, 1)
    joined = (
        grams.withColumn("k", F.lit(0))
        .join(contexts(seen, ["a", "b"], "c3", d3, 3), ["a", "b"], "left")
        .join(pairs, ["b", "c"], "left")
        .join(contexts(pairs, ["b"], "c2", d2, 2), "b", "left")
        .join(singles, "c", "left")
        .join(all_singles, "k", "left")
    )

    def level(count: str, total: str, back: str, discounts: list[float], lower: Column) -> Column:
        own = F.coalesce(F.col(count), F.lit(0))
        here = F.greatest(own - _discount(own, discounts), F.lit(0.0)) / F.col(total) + F.col(back) * lower
        return F.when(F.col(total).isNull(), lower).otherwise(here)

    p = level("c1", "t1", "g1", d1, F.lit(1.0 / SYMBOLS))
    p = level("c2", "t2", "g2", d2, p)
    p = level("c3", "t3", "g3", d3, p)
    return joined.select("code", F.round(-F.log(p) * UNIT).cast("long").alias("cost"))


#: A trigram's costs under all trusted text, and under that without each fold.
COSTS = ("cost", *[f"cost_{i}" for i in range(FOLDS)])
_PROFILE = "row long, shard int, doc_id {ids}, tag long, lang string, fold int, codes binary, counts binary"


def _profiles(flagged: DataFrame, points: list[int], ids: str, shards: int) -> DataFrame:
    """A row per document and shard: its distinct trigrams there, and how often each occurs.

    The shard is the remainder of a trigram, and what is kept is the quotient, in as few bytes as all fit in.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, row = Grams(points), TaskContext.get().partitionId() << 40
        width, n = np.uint64(3 * grams.bits), np.uint64(shards)
        mask, size = np.uint64((1 << 3 * grams.bits) - 1), code_bytes(grams.bits, shards)
        for batch in batches:
            for begin, texts in _slices(batch.column(0), grams.most_docs):
                doc, codes = grams.of(texts)
                keys = np.sort(doc.astype(np.uint64) << width | codes)
                starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
                counts = np.diff(np.r_[starts, len(keys)])
                # A count above 255 is several entries.
                times = -(-counts // 255)
                distinct = np.repeat(keys[starts], times)
                parts = np.full(len(distinct), 255)
                parts[np.cumsum(times) - 1] = counts - 255 * (times - 1)
                code = distinct & mask
                group = (distinct >> width).astype(np.int64) * shards + (code % n).astype(np.int64)
                order = np.argsort(group, kind="stable")
                group, code, parts = group[order], code[order] // n, parts[order]
                first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
                bounds = np.r_[first, len(distinct)]
                where = group[first] // shards
                # The first shard that a document has carries its columns.
                head = np.r_[True, where[1:] != where[:-1]]
                at = pa.array(np.where(head, where + begin, -1), mask=~head)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row + begin + where),
                        pa.array((group[first] % shards).astype(np.int32)),
                        *[batch.column(i).take(at) for i in (1, 2, 3, 4)],
                        _binary(code.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size], bounds),
                        _binary(parts.astype(np.uint8).reshape(-1, 1), bounds),
                    ],
                    ["row", "shard", "doc_id", "tag", "lang", "fold", "codes", "counts"],
                )
            row += len(batch)

    rows = flagged.select("text", "doc_id", "tag", "lang", "fold")
    return rows.mapInArrow(run, _PROFILE.format(ids=ids))


def code_bytes(bits: int, shards: int) -> int:
    return -(-(((1 << 3 * bits) - 1) // shards).bit_length() // 8) or 1


def _binary(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """A value per group of rows of bytes."""
    offsets = (bounds * values.shape[1]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(values.tobytes())])


def _scored(profiles: DataFrame, model: DataFrame, bits: int, shards: int, blocks: int, ids: str) -> DataFrame:
    """``row``, its columns, and the ``cost`` and number of its trigrams, by a join shard by shard."""
    size = code_bytes(bits, shards)
    dealt = profiles.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks).cast("long")))
    mask = F.lit((1 << _BITS) - 1)
    first, second, third = F.shiftright("code", 2 * _BITS), F.shiftright("code", _BITS).bitwiseAND(mask), F.col("code").bitwiseAND(mask)
    packed = F.shiftleft(first, 2 * bits).bitwiseOR(F.shiftleft(second, bits)).bitwiseOR(third)
    held = (
        model.select(packed.alias("code"), *COSTS)
        .groupBy((F.col("code") % shards).cast("int").alias("shard"))
        .agg(F.sort_array(F.collect_list(F.struct(F.expr(f"code div {shards}").alias("at"), *COSTS))).alias("_grams"))
        .select("shard", *[F.col(f"_grams.{c}").alias(c) for c in ("at", *COSTS)])
        .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    )

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        at = right["at"].combine_chunks().values.to_numpy()
        sizes = np.array([len(c.as_py()) for c in left["counts"]], np.int64)
        whole = np.zeros((int(sizes.sum()), 8), np.uint8)
        whole[:, :size] = np.frombuffer(b"".join(left["codes"].to_pylist()), np.uint8).reshape(-1, size)
        codes = whole.view("<u8").ravel().astype(np.int64)
        counts = np.frombuffer(b"".join(left["counts"].to_pylist()), np.uint8).astype(np.int64)
        begins = np.cumsum(sizes) - sizes
        place = np.searchsorted(at, codes)
        out = left.select(["row", "doc_id", "tag", "lang", "fold"])
        for name in (*COSTS, "n"):
            values = counts if name == "n" else counts * (right[name].combine_chunks().values.to_numpy()[place] if len(codes) else 0)
            out = out.append_column(name, pa.array(np.add.reduceat(values, begins) if len(codes) else values))
        return out

    schema = f"row long, doc_id {ids}, tag long, lang string, fold int, {', '.join(f'{c} long' for c in COSTS)}, n long"
    parts = dealt.groupBy("shard", "block").cogroup(held.groupBy("shard", "block")).applyInArrow(meet, schema)
    carried = [F.max(c).alias(c) for c in ("doc_id", "tag", "lang", "fold")]
    return parts.groupBy("row").agg(*carried, *[F.sum(c).alias(c) for c in (*COSTS, "n")]).drop("row")


def perplexities(docs: DataFrame, trusted: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``, ``lang``), judged by ``trusted`` (``doc_id``).

    Returns ``doc_id``, ``tag`` (a hash of the text), ``lang``, ``is_trusted``, ``n`` (characters
    and the end), ``perplexity`` under all trusted text, ``entropy`` (held out, drawn to the mean), ``threshold`` and ``kept``.
    Null texts count as empty. Languages with few trusted documents, and null, take the threshold
    of all; without trusted documents every row is kept. Repeated rows come back as often.
    """
    ids = docs.schema["doc_id"].dataType.simpleString()
    good = settle(trusted.select(F.col("doc_id").alias("_good")).filter("_good is not null").distinct())
    text = whole_text(F.col("text"))
    flagged = (
        docs.select("doc_id", F.col("lang").cast("string"), text.alias("text"), F.xxhash64(text).alias("tag"))
        .join(small(good, max_rows), F.col("doc_id") == F.col("_good"), "left")
        # Equal texts are in one fold, else they would not be held out.
        .withColumn("fold", F.when(F.col("_good").isNull(), -1).otherwise(F.pmod(F.xxhash64(F.lit("fold"), "tag"), F.lit(FOLDS))).cast("int"))
    )
    points = alphabet(docs)
    model = held_out(gram_counts(flagged, points))
    shards = LEAST_SHARDS + 2 * (model.count() // (2 * SHARD_GRAMS))  # odd, so that all three symbols count in the remainder
    blocks = 1 + docs.count() * LEAST_SHARDS // (BLOCK_DOCS * shards)
    profiles = _profiles(flagged, points, ids, shards)
    scores = settle(_scored(profiles, model, symbol_bits(points), shards, blocks, ids))
    return _judged(scores, max_rows)


def _judged(scores: DataFrame, max_rows: int) -> DataFrame:
    own = F.coalesce(*[F.when(F.col("fold") == i, F.col(f"cost_{i}")) for i in range(FOLDS)], F.col("cost"))
    scores = scores.withColumn("is_trusted", F.col("fold") >= 0).withColumn("_own", own)
    sums = scores.filter("is_trusted").agg(F.sum("_own"), F.sum("n")).first()
    mean = sums[0] / sums[1] if sums[1] else 0.0
    drawn = (F.col("_own") + F.lit(PRIOR_CHARS * mean)) / (F.col("n") + PRIOR_CHARS) / UNIT
    binned = scores.withColumn("entropy", drawn).withColumn("_bin", F.floor(F.col("entropy") / _BIN))
    good = binned.filter("is_trusted")
    bins = good.groupBy("lang", "_bin").agg(F.count(F.lit(1)).alias("_n"))
    by_lang = _quantile(bins, ["lang"]).filter(F.col("_all") >= LEAST_TRUSTED)
    overall = _quantile(bins.groupBy("_bin").agg(F.sum("_n").alias("_n")).withColumn("_k", F.lit(0)), ["_k"]).first()
    limits = settle(by_lang.select(F.col("lang").alias("_lang"), "_limit"))
    most = F.coalesce("_limit", F.lit(overall["_limit"] if overall else None).cast("long"))
    threshold = (most + 1) * _BIN
    return (
        binned.join(small(limits, max_rows), F.col("lang") == F.col("_lang"), "left")
        .withColumn("threshold", threshold)
        .select(
            "doc_id", "tag", "lang", "is_trusted", "n",
            F.exp(F.col("cost") / F.col("n") / UNIT).alias("perplexity"),
            "entropy", "threshold",
            ((F.col("n") == 1) | F.coalesce(F.col("entropy") <= F.col("threshold"), F.lit(True))).alias("kept"),
        )
    )


def _quantile(bins: DataFrame, by: list[str]) -> DataFrame:
    """The lowest bin at or below which ``QUANTILE`` of each group lie, and the group's size."""
    upto = Window.partitionBy(*by).orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0)
    summed = bins.withColumn("_upto", F.sum("_n").over(upto)).withColumn("_all", F.sum("_n").over(Window.partitionBy(*by)))
    return summed.filter(F.col("_upto") >= F.col("_all") * QUANTILE).groupBy(*by).agg(
        F.min("_bin").alias("_limit"), F.max("_all").alias("_all")
    )


def drop_rejected(docs: DataFrame, trusted: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    rejected = perplexities(docs, trusted, max_rows).filter(~F.col("kept"))
    gone = small(settle(rejected.select(F.col("doc_id").alias("_id"), F.col("tag").alias("_tag")).distinct()), max_rows)
    same = reduce(
        lambda a, b: a & b,
        [F.col("doc_id").eqNullSafe(F.col("_id")), F.xxhash64(whole_text(F.col("text"))) == F.col("_tag")],
    )
    return restored(carried(docs).join(gone, same, "left_anti"))
