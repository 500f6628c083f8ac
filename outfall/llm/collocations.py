"""Phrase collocations by SON partitioning.

The texts are dealt into shards, rows of some megabytes of text in one language. Every shard is mined
completely: the distinct phrases in it are counted exactly over word numbers, and those whose count
reaches the shard's share of the support are listed, as fingerprints. A phrase whose count stays
below the support share in every shard stays below the support in all, so the union of the lists has
every frequent phrase. What the shards say about a fingerprint also bounds its count from above, so
only those that can reach the support are candidates. Each shard is then told, by a bit for each phrase on its list,
which are candidates, and counts these by their words, and the counts are added up: fingerprints
that coincide cost a little work and change no count.

The lists are packed: sorted fingerprints as differences, in blocks by bucket. There are more buckets
where there is more text, so that neither a block's shard nor a bucket grows with the corpus. A
phrase is once in a shard's list however often it occurs, so no phrase is a hot key.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from outfall.llm import blocks
from outfall.llm.words import BROADCAST_ROWS, settled_small, whole_text
from outfall.session import settle

SUPPORT = 10
MAX_WORDS = 3
#: A candidate goes when a longer one around it has this many hundredths of its count.
LONGER_PERCENT = 50
TOP = 2000
#: Bytes of text in a shard; a longer text is a shard of its own, or the last text of one.
SHARD_BYTES = 4 * 1024 * 1024
#: Bytes of it whose words are cut at once.
SLICE_BYTES = 1024 * 1024
#: Parts in which a language is ranked before their first rows are ranked together.
RANK_PARTS = 16
NO_LANG = "und"
#: Stands between texts and for every character that ends a piece; no UTF-8 text has this byte.
_MARK = b"\xff"
_ENDS = b".,;:!?\n\x0b\x0c\r"
_UPPER = bytes(range(65, 91))
_TABLE = bytes.maketrans(_UPPER + _ENDS + b"\t", _UPPER.lower() + _MARK * len(_ENDS) + b" ")
_GAP = re.compile(b"[ \xff]")
_SEED = 20_240_607
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_BLOCKS = "bucket long, shard long, allowed long, listed binary"


def shards(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The texts of ``docs`` as rows ``shard``, ``lang``, ``size`` and ``body`` (compressed), written down."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = count(TaskContext.get().partitionId() << 33)
        pack = zstandard.ZstdCompressor(level=3).compress
        held: dict[str, list[bytes]] = defaultdict(list)
        sizes: dict[str, int] = defaultdict(int)

        def take(lang: str) -> pa.RecordBatch:
            size, body = sizes.pop(lang), pack(_MARK.join(held.pop(lang)))
            columns = [pa.array([next(numbers)]), pa.array([lang]), pa.array([size]), pa.array([body], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, ["shard", "lang", "size", "body"])

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py()
                held[lang].append(text)
                sizes[lang] += len(text) + 1
                if sizes[lang] >= shard_bytes:
                    yield take(lang)
            while sum(sizes.values()) > 2 * shard_bytes:  # many languages
                yield take(max(sizes, key=sizes.get))
        for lang in sorted(sizes):
            yield take(lang)

    texts = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)).alias("lang"),
        whole_text(F.col("text")).cast("binary").alias("text"),
    )
    return settle(texts.mapInArrow(run, "shard long, lang string, size long, body binary"))


def numbered_words(text: bytes) -> tuple[np.ndarray, list[bytes]]:
    """The words of a text as numbers, and the distinct words; number 0 is what ends a piece."""
    numbers: dict[bytes, int] = defaultdict(count().__next__)
    numbers[_MARK]
    ids, at = [], 0
    while at < len(text):
        # In slices, so that there are never as many objects as words.
        cut = _GAP.search(text, at + SLICE_BYTES)
        end = cut.start() if cut else len(text)
        words = text[at:end].replace(_MARK, b" " + _MARK + b" ").split()
        ids.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
        at = end
    return np.concatenate([np.zeros(0, np.int32), *ids]), list(numbers)


class Mined:
    """All phrases of a shard: of each number of words the places of their first words, and their counts."""

    def __init__(self, body: bytes, max_words: int):
        ids, self.words = numbered_words(zstandard.ZstdDecompressor().decompress(body).translate(_TABLE))
        hashes = np.fromiter((xxhash.xxh64_intdigest(w, _SEED) for w in self.words), np.uint64, len(self.words))
        self.ids = ids
        self.n_words = int(np.count_nonzero(ids))
        self.places: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.prints: list[np.ndarray] = []
        #: Of each place: the number of the phrase of n words that begins there, or -1.
        begins = np.where(ids > 0, 0, -1).astype(np.int32)
        prints = np.zeros(1, np.uint64)
        for n in range(1, max_words + 1):
            begins = begins[: max(0, len(ids) - n + 1)]
            last = ids[n - 1 :]
            at = np.flatnonzero((begins >= 0) & (last > 0)).astype(np.int32)
            places, counts, numbers = _distinct(begins[at] * np.int64(len(hashes)) + last[at], n < max_words)
            places = at[places]
            prints = _mixed(prints[begins[places]] * _MULTIPLIER + hashes[last[places]] + np.uint64(n))
            if n < max_words:
                begins = np.full(len(begins), -1, np.int32)
                begins[at] = numbers
            self.places.append(places)
            self.counts.append(counts)
            self.prints.append(prints)

    def keys(self, lang: str, bits: int) -> np.ndarray:
        """The keys of all phrases, as ``blocks`` has them."""
        salt = np.uint64(xxhash.xxh64_intdigest(lang, _SEED))
        return blocks.keys_of(_mixed(np.concatenate(self.prints) ^ salt), bits)

    def listing(self, lang: str, allowed: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of the phrases that occur ``allowed`` times, and their keys, in ascending order of these.

        Phrases that share a key may come in any order, as what is told of one is told of the other.
        """
        keys = self.keys(lang, bits)
        listed = np.flatnonzero(np.concatenate(self.counts) >= allowed).astype(np.int32)
        keys = keys[listed]
        order = np.argsort(keys)
        return listed[order], keys[order]

    def phrase(self, place: int, n: int) -> str:
        return b" ".join([self.words[i] for i in self.ids[place : place + n].tolist()]).decode(errors="replace")


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _distinct(keys: np.ndarray, numbered: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """A place and the count of each distinct key, in ascending order, and the number of each key among these."""
    order = np.argsort(keys).astype(np.int32)
    is_new = np.diff(keys[order], prepend=-1) != 0
    first = np.flatnonzero(is_new).astype(np.int32)
    counts = np.diff(first, append=np.int32(len(keys)))
    numbers = None
    if numbered:
        numbers = np.empty(len(keys), np.int32)
        numbers[order] = np.cumsum(is_new, dtype=np.int32) - 1
    return order[first], counts, numbers


def share_of_support(size: Column, total: int, support: int) -> Column:
    """The least count that a shard lists: its part of the support, rounded up."""
    return F.greatest(F.lit(1), F.ceil(F.lit(support) * size / F.lit(float(total)))).cast("long")


def mined_lists(rows: DataFrame, bits: int, max_words: int) -> DataFrame:
    """Of every shard (``allowed`` is its part of the support) the phrases that reach it, as blocks by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, lang, allowed, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                mined = Mined(body, max_words)
                listed, keys = mined.listing(lang, allowed, bits)
                counts = np.concatenate(mined.counts)[listed]
                buckets, low = blocks.parts_of(keys)
                found = [(b, blocks.packed(low[part], counts[part])) for b, part in blocks.runs(buckets)]
                n = len(found)
                columns = [[b for b, _ in found], [shard] * n, [allowed] * n]
                arrays = [*(pa.array(c, pa.int64()) for c in columns), pa.array([d for _, d in found], pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, ["bucket", "shard", "allowed", "listed"])

    return rows.select("shard", "lang", "allowed", "body").mapInArrow(run, _BLOCKS)


def candidate_lists(lists: DataFrame, large: list[int], slack: int, support: int) -> DataFrame:
    """Of every block, as ``chosen``, which of its phrases may reach ``support`` in all (compressed bits).

    A shard that does not list one has ``allowed - 1`` of it at most; ``slack`` is the sum of that over all shards. The
    ``large`` shards, which may have phrases that they do not list, get all fingerprints instead.
    """

    def run(table: pa.Table) -> pa.Table:
        lists = [blocks.unpacked(d, 2) for d in table.column("listed").to_pylist()]
        sizes = [b.shape[1] for b in lists]
        allowed = np.repeat(table.column("allowed").to_numpy(), sizes)
        low, counts = np.concatenate(lists, axis=1)
        prints, which = np.unique(low, return_inverse=True)
        stays = np.bincount(which, weights=counts - (allowed - 1)) + slack >= support
        pack = zstandard.ZstdCompressor(level=3).compress
        chosen = [(s, pack(prints[stays].astype("<u4").tobytes())) for s in large] if stays.any() else []
        parts = np.split(stays[which], np.cumsum(sizes)[:-1])
        for shard, part in zip(table.column("shard").to_pylist(), parts, strict=True):
            if shard not in large and part.any():
                chosen.append((shard, blocks.packed_bits(part)))
        buckets = np.full(len(chosen), table.column("bucket")[0].as_py())
        columns = [pa.array(buckets, pa.int64()), pa.array([s for s, _ in chosen], pa.int64()), pa.array([c for _, c in chosen], pa.binary())]
        return pa.Table.from_arrays(columns, ["bucket", "shard", "chosen"])

    return lists.groupBy("bucket").applyInArrow(run, "bucket long, shard long, chosen binary")


def counted(rows: DataFrame, lists: DataFrame, large: list[int], bits: int, max_words: int) -> DataFrame:
    """Exact counts of the candidates in all shards, and with ``n_words`` 0 the number of words per language.

    A shard is mined again, and gives its list in the same order, so that the bits tell which are meant.
    """

    def run(shard: pa.Table, found: pa.Table) -> pa.Table:
        unpack = zstandard.ZstdDecompressor().decompress
        told = dict(zip(found.column("bucket").to_pylist(), found.column("chosen").to_pylist(), strict=True))
        langs, sizes, phrases, counts = [], [], [], []
        for number, lang, allowed, body in zip(*(shard.column(c).to_pylist() for c in ("shard", "lang", "allowed", "body")), strict=True):
            mined = Mined(body, max_words)
            if number in large:
                wanted = [np.frombuffer(unpack(c), "<u4").astype(np.uint64) | np.uint64(b << 32) for b, c in told.items()]
                chosen = np.flatnonzero(np.isin(mined.keys(lang, bits), np.concatenate([np.zeros(0, np.uint64), *wanted])))
            else:
                listed, keys = mined.listing(lang, allowed, bits)
                chosen = np.sort(listed[blocks.unpacked_bits(blocks.parts_of(keys)[0], told)])
            sizes.append(0), phrases.append(""), counts.append(mined.n_words)
            start = 0
            for n, places in enumerate(mined.places, 1):
                mine = chosen[(chosen >= start) & (chosen < start + len(places))] - start
                phrases += [mined.phrase(p, n) for p in places[mine].tolist()]
                counts += mined.counts[n - 1][mine].tolist()
                sizes += [n] * len(mine)
                start += len(places)
            langs += [lang] * (len(sizes) - len(langs))
        columns = [pa.array(langs, pa.string()), pa.array(sizes, pa.int32()), pa.array(phrases, pa.string()), pa.array(counts, pa.int64())]
        return pa.Table.from_arrays(columns, ["lang", "n_words", "phrase", "count"])

    schema = "lang string, n_words int, phrase string, count long"
    held = rows.select("shard", "lang", "allowed", "body")
    each = held.groupBy("shard").cogroup(lists.groupBy("shard")).applyInArrow(run, schema)
    return each.groupBy("lang", "n_words", "phrase").agg(F.sum("count").alias("count"))


def frequent_phrases(
    docs: DataFrame,
    support: int = SUPPORT,
    max_words: int = MAX_WORDS,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """``lang``, ``n_words``, ``phrase`` and ``count`` of all phrases of up to ``max_words`` words that occur
    ``support`` times or more, and with ``n_words`` 0 the number of all words of the language.
    """
    rows = shards(docs, shard_bytes)
    total = rows.agg(F.sum("size")).first()[0] or 1
    rows = rows.withColumn("allowed", share_of_support(F.col("size"), total, support))
    slack = rows.agg(F.sum(F.col("allowed") - 1)).first()[0] or 0
    bits = blocks.bucket_bits(total * max_words // 6)  # a word and what follows it take six bytes or so
    # Fewer than the support, as each has more than that part of the text.
    large = [r["shard"] for r in rows.filter(F.col("allowed") > 1).select("shard").collect()]
    lists = candidate_lists(mined_lists(rows, bits, max_words), large, slack, support)
    every = counted(rows, lists, large, bits, max_words)
    return settle(every.filter((F.col("count") >= support) | (F.col("n_words") == 0)))


def _cut(phrase: Column, first: Column | int, n: Column | int) -> Column:
    return F.array_join(F.slice(F.split(phrase, " "), first, n), " ")


def scored(frequent: DataFrame, max_words: int = MAX_WORDS, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Phrases of two words or more with ``a``, ``l``, ``r``, ``n`` and ``score`` of their weakest cut."""
    sized = [frequent.filter(F.col("n_words") == n).select("lang", "phrase", "count") for n in range(max_words + 1)]
    parts = {n: settled_small(sized[n], max_rows) for n in range(1, max_words)}
    best = []
    for n in range(2, max_words + 1):
        cuts = []
        for k in range(1, n):
            cut = sized[n].select(
                "lang", "phrase", F.col("count").alias("a"), F.lit(k).alias("k"),
                _cut(F.col("phrase"), 1, k).alias("first"), _cut(F.col("phrase"), k + 1, n).alias("rest"),
            )
            for side, name, size in (("first", "l", k), ("rest", "r", n - k)):
                part = parts[size].select("lang", F.col("phrase").alias(side), F.col("count").alias(name))
                cut = cut.join(part, ["lang", side])
            # Products have 37 digits at most.
            a, left, right = (F.col(c).cast("decimal(15,0)") for c in ("a", "l", "r"))
            cut = cut.withColumn("_above", a * a * F.lit(1_000_000).cast("decimal(7,0)")).withColumn("_below", left * right)
            cuts.append(cut.select("lang", "phrase", "a", F.struct(F.expr("_above div _below").alias("score"), "k", "l", "r").alias("_cut")))
        every = reduce(DataFrame.unionByName, cuts)
        best.append(every if n == 2 else every.groupBy("lang", "phrase", "a").agg(F.min("_cut").alias("_cut")))
    totals = settled_small(sized[0].select("lang", F.col("count").alias("n")), max_rows)
    marked = reduce(DataFrame.unionByName, best).join(totals, "lang")
    return marked.select("lang", "phrase", "a", "_cut.l", "_cut.r", "n", "_cut.score")


def inside_longer(frequent: DataFrame, max_words: int = MAX_WORDS) -> DataFrame:
    """``lang``, ``phrase`` and ``around``, the largest count of a longer frequent phrase that has it inside."""
    longer = frequent.filter(F.col("n_words") > 2)
    spans = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.col("n_words") - 1),
            lambda n: F.transform(F.sequence(F.lit(1), F.col("n_words") - n + 1), lambda i: _cut(F.col("phrase"), i, n)),
        )
    )
    inside = longer.select("lang", F.explode(spans).alias("phrase"), F.col("count").alias("around"))
    return inside.groupBy("lang", "phrase").agg(F.max("around").alias("around"))


def collocations(
    docs: DataFrame,
    support: int = SUPPORT,
    max_words: int = MAX_WORDS,
    top: int | None = TOP,
    longer_percent: int = LONGER_PERCENT,
    shard_bytes: int = SHARD_BYTES,
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """The ``top`` phrases of each language (all without ``top``) by ``score``.

    Reads ``lang`` and ``text`` of ``docs``, no other column. Returns ``lang``, ``rank`` (from 1), ``phrase``, ``a``
    (its count), ``l`` and ``r`` (counts of the two parts of its weakest cut), ``n`` (all words of the language) and
    ``score``. A null language is ``und``, null texts are empty, and repeated rows count as often as they are there.
    Equal scores are ranked by count, then by phrase, so there are no ties. An empty table gives no rows.
    """
    frequent = frequent_phrases(docs, support, max_words, shard_bytes)
    around = settled_small(inside_longer(frequent, max_words), max_rows)
    marked = scored(frequent, max_words, max_rows).join(around, ["lang", "phrase"], "left")
    stay = marked.filter(F.col("around").isNull() | (100 * F.col("around") < longer_percent * F.col("a")))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    if top is not None:
        part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
        first = F.row_number().over(Window.partitionBy("lang", part).orderBy(*order))
        stay = stay.withColumn("_place", first).filter(F.col("_place") <= top).drop("_place")
    ranked = stay.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    ranked = ranked if top is None else ranked.filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
