import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from outfall.llm import blocks, collocations


def brute(rows, support=10, top=2000, percent=50):
    found, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = lang or "und"
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", lower):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for m in (1, 2, 3):
                found[lang].update(" ".join(words[i : i + m]) for i in range(len(words) - m + 1))
    result = set()
    for lang, f in found.items():
        frequent = {p: a for p, a in f.items() if " " in p and a >= support}
        around = Counter()
        for p, a in frequent.items():
            if p.count(" ") == 2:
                words = p.split(" ")
                for inside in (" ".join(words[:2]), " ".join(words[1:])):
                    around[inside] = max(around[inside], a)
        scored = []
        for p, a in frequent.items():
            if 100 * around[p] >= percent * a:
                continue
            words = p.split(" ")
            cuts = []
            for k in range(1, len(words)):
                left, right = f[" ".join(words[:k])], f[" ".join(words[k:])]
                cuts.append((1_000_000 * a * a // (left * right), k, left, right))
            score, _, left, right = min(cuts)
            scored.append((-score, -a, p.encode(), p, left, right))
        for rank, (score, a, _, p, left, right) in enumerate(sorted(scored)[:top], 1):
            result.add((lang, rank, p, -a, left, right, n[lang], -score))
    return result


def texts(seed, docs=60):
    rng = random.Random(seed)
    words = ["New", "york", "city", "a", "b", "é", "x\x00y", "\x1c", "日本", "the"]
    ends = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", "! "]
    return [
        (rng.choice(["en", "de", None]), "".join(rng.choice(words) + rng.choice(ends) for _ in range(rng.randint(0, 200))))
        for _ in range(docs)
    ]


@pytest.mark.parametrize("seed, shard_bytes", [(1, 300), (2, 5_000), (3, 1 << 23), (4, 1)])
def test_against_brute_force(spark, seed, shard_bytes):
    rows = texts(seed) + [("en", None), ("en", ""), (None, "... ,,")]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    got = collocations.collocations(df, shard_bytes=shard_bytes).collect()
    assert len(got) == len({tuple(r) for r in got})
    assert {tuple(r) for r in got} == brute(rows)


def test_top_and_shuffled_ways(spark):
    rows = texts(5, 100)
    df = spark.createDataFrame(rows, "lang string, text string")
    assert {tuple(r) for r in collocations.collocations(df, top=3, max_rows=0).collect()} == brute(rows, top=3)


def test_shards_list_less_where_there_are_few(spark):
    """With four shards alike, each lists only what it has three times: a quarter of the support, rounded up."""
    text = "x y " * 3 + "p q "
    df = spark.createDataFrame([("en", text)] * 4, "lang string, text string").coalesce(1)
    rows = collocations.shards(df, shard_bytes=len(text))
    from pyspark.sql import functions as F

    assert rows.count() == 4
    rows = rows.withColumn("allowed", collocations.share_of_support(F.col("size"), 4 * (len(text) + 1), 10))
    assert {r["allowed"] for r in rows.collect()} == {3}
    lists = collocations.mined_lists(rows, 9, 2).collect()
    assert sum(blocks.unpacked(b["listed"], 2).shape[1] for b in lists) == 4 * 3  # x, y and x y
    assert {tuple(r)[2] for r in collocations.collocations(df, shard_bytes=len(text)).collect()} == {"x y"}


def test_fingerprints_that_coincide_change_no_count(spark, monkeypatch):
    """Functions of the package are sent by name, so tasks see what is set only if it is part of an argument."""
    rows = texts(6)
    df = spark.createDataFrame(rows, "lang string, text string")
    held = collocations.shards(df, 2_000)
    held = held.withColumn("allowed", collocations.F.lit(1).cast("long"))
    bits = -26  # six bits in all, so that most phrases share a fingerprint
    lists = collocations.candidate_lists(collocations.mined_lists(held, bits, 3), [], 0, 10)
    every = collocations.counted(held, lists, [], bits, 3)
    got = {(r["lang"], r["phrase"]): r["count"] for r in every.filter("n_words > 1 AND count >= 10").collect()}
    assert {(lang, p, a) for (lang, p), a in got.items()} >= {(x[0], x[2], x[3]) for x in brute(rows, percent=10**9)}


def test_packing():
    low, counts = np.array([0, 5, 6, 2**32 - 1]), np.array([1, 2, 3, 70_000])
    assert blocks.unpacked(blocks.packed(low, counts), 2).tolist() == [low.tolist(), counts.tolist()]
    assert blocks.unpacked(blocks.packed(low), 1).tolist() == [low.tolist()]
    buckets = np.array([0, 0, 3, 3, 3, 9])
    bits = np.array([True, False, True, True, False, False])
    told = {b: blocks.packed_bits(bits[part]) for b, part in blocks.runs(buckets) if bits[part].any()}
    assert blocks.unpacked_bits(buckets, told).tolist() == bits.tolist() and 9 not in told
    assert blocks.bucket_bits(0) == 9 and blocks.bucket_bits(10**13) == 22


def test_words_are_the_same_in_slices(monkeypatch):
    text = b"ab  c" + b"\xff" + b"ab " + b"x" * 50 + b"\xff\xff c "
    whole = collocations.numbered_words(text)
    for size in range(1, 20):
        monkeypatch.setattr(collocations, "SLICE_BYTES", size)
        ids, words = collocations.numbered_words(text)
        assert ids.tolist() == whole[0].tolist() and words == whole[1]


def test_no_rows_and_odd_rows(docs):
    assert collocations.collocations(docs([])).collect() == []
    got = collocations.collocations(docs([(1, "a b " * 20), (1, "a b " * 20), (None, None), (2, "w " * 300_000)], clashes=True))
    assert {r["phrase"] for r in got.collect()} >= {"w w w"}
