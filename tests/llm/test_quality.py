import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from outfall.llm import kneser_ney, mixing, pii, repetition, sharding

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, hit):
    digits = re.sub("[^0-9]", "", hit)
    turned = [int(c) for c in digits][::-1]
    luhn = sum(turned[::2]) + sum(sum(divmod(2 * d, 10)) for d in turned[1::2])
    return {
        "email": True,
        "ip": all(int(p) <= 255 for p in hit.split(".")) if kind == "ip" else None,
        "card": 13 <= len(digits) <= 19 and luhn % 10 == 0,
        "phone": 9 <= len(digits) <= 15,
    }[kind]


def base_spans(text):
    return [
        f"{k}:{m.start()}:{m.end()}" for k in BASE for m in re.finditer(BASE[k], text or "") if passes(k, m.group())
    ]


def test_base_spans_match_brute_force(spark, sample, docs):
    rng = random.Random(4)
    alphabet = ["a", "é", "@", ".", "-", " ", "1", "4", "0", "+", "(", ")", "_", "4111111111111111", "1.2.3.4", "a@b.c", "🎉"]
    made = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(600)]
    made += ["a@b.c_d@e.f", "00255.1.2.0003", "1.2.3.256 1.2.3.4.5", "+1 (269) 555-3296 4524132264652876", None]
    for df in (docs(made), spark.read.parquet(f"{sample}/documents.parquet")):
        texts = {r["doc_id"]: r["text"] for r in df.collect()}
        for r in pii.find_personal_data(df).collect():
            spans = base_spans(texts[r["doc_id"]])
            assert r["base_sha256"] == hashlib.sha256(",".join(spans).encode()).hexdigest()
            assert set(spans) <= set(r["spans"].split(",")) | {""}
            assert [r[f"n_{k}"] for k in BASE] == [sum(s.startswith(k) for s in spans) for k in BASE]


def test_reliabilities_find_the_honest_labeler(spark):
    rng = random.Random(6)
    rows = []
    for i in range(4000):
        true = rng.random() < 0.5
        right = [0.97, 0.9, 0.85, 0.5]  # the last one guesses
        rows.append((i, "card", *[(1 if true else -1) * (1 if rng.random() < p else -1) for p in right]))
    found = spark.createDataFrame(rows, "row long, kind string, " + ", ".join(f"{v} int" for v in pii.LABELERS))
    likely = {tuple(r[v] for v in pii.LABELERS): r["likely"] for r in pii.reliabilities(found).collect()}
    assert likely[1, 1, 1, -1] > 0.95 and likely[-1, -1, -1, 1] < 0.05
    assert abs(likely[1, 1, 1, 1] - likely[1, 1, 1, -1]) < 0.1 and likely[1, -1, -1, 1] > likely[-1, -1, 1, 1]


def test_redaction(docs):
    df = docs(["write to é@x a.b@c.de or 1.2.3.4 now", "nothing"])
    out = {r["doc_id"]: r["text"] for r in pii.redact(df, pii.find_personal_data(df)).collect()}
    assert out == {0: "write to é@x <email> or <ip> now", 1: "nothing"}


def brute_repetition(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    at = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    under = {j for i in range(len(words) - 7) if at[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [line for line in (text or "").split("\n") if line.strip(" \t\n\x0b\x0c\r")]
    repeats = len(lines) - len(set(lines))
    result = [len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), repeats, len(under)]
    for n in repetition.MOST_REPEATED:
        seen, covered = set(), set()
        for i in range(len(words) - n + 1):
            gram = tuple(words[i : i + n])
            covered |= set(range(i, i + n)) if gram in seen else set()
            seen.add(gram)
        result.append(sum(len(words[j]) for j in covered))
    return result


def test_repetition_matches_brute_force(docs):
    rng = random.Random(8)
    texts = ["".join(rng.choice(["a ", "b ", "é ", "\n", "a b a b a b a b\n", "x|y "]) for _ in range(rng.randrange(60))) for _ in range(300)]
    texts += [None, "", "w" * 10, "the same words again and again " * 50]
    got = {r["doc_id"]: r for r in repetition.repetition(docs(texts)).collect()}
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", *[f"dup_{n}gram_chars" for n in repetition.MOST_REPEATED]]
    for i, text in enumerate(texts):
        r, expected = got[i], brute_repetition(text)
        assert [r[c] for c in names] == expected
        assert r["base_failed"] == (expected[0] < 20 or 100 * expected[4] > 30 * expected[0])
        assert not (r["kept"] and r["base_failed"])
    assert not got[len(texts) - 1]["kept"]


@pytest.mark.parametrize("n", [0, 1, 2, 3, 17, 1000, 4097])
def test_permutation_is_one_and_turns_back(n):
    p = sharding.Permutation(n, 5)
    out = p.forward(np.arange(n))
    assert sorted(out.tolist()) == list(range(n)) and p.backward(out).tolist() == list(range(n))
    assert n < 17 or out.tolist() != sharding.Permutation(n, 6).forward(np.arange(n)).tolist()


def test_shards_are_even_and_lasting(docs):
    rows = [(i * 7, f"text é {i % 50}" if i % 9 else None) for i in range(1003)]
    got = sharding.assign_shards(docs(rows), 16, 3).collect()
    places = defaultdict(list)
    for r in got:
        places[r["shard"]].append(r["slot"])
        assert sharding.row_at(r["shard"], r["slot"], 1003, 3, 16) == r["row_number"]
    assert all(sorted(s) == list(range(len(s))) for s in places.values()) and len(places) == 16
    assert max(map(len, places.values())) - min(map(len, places.values())) <= 1
    again = sharding.assign_shards(docs(rows[::-1]).repartition(7), 16, 3).collect()
    assert {(r["doc_id"], r["shard"], r["slot"]) for r in got} == {(r["doc_id"], r["shard"], r["slot"]) for r in again}


def brute_kneser_ney(counts, size):
    """Costs of (a, b, c) by the textbook recursion over plain dictionaries."""
    pairs, singles = Counter((b, c) for _, b, c in counts), Counter()
    singles.update(c for _, c in pairs)

    def discounts(values):
        n = Counter(values)
        n1, n2, n3, n4 = (n[i] for i in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2) if n1 else 0.5
        raw = [1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5]
        return [0.0, *[min(max(d, 0.05), i + 0.95) for i, d in enumerate(raw)]]

    ds = [discounts(t.values()) for t in (singles, pairs, counts)]

    def p(table, d, context, gram, lower):
        held = {g: n for g, n in table.items() if context(g)}
        total = sum(held.values())
        if not total:
            return lower
        own = table.get(gram, 0)
        return max(own - d[min(own, 3)], 0) / total + sum(d[min(n, 3)] for n in held.values()) / total * lower

    def cost(a, b, c):
        low = p(singles, ds[0], lambda g: True, c, 1 / size)
        low = p(pairs, ds[1], lambda g: g[0] == b, (b, c), low)
        return -math.log(p(counts, ds[2], lambda g: g[:2] == (a, b), (a, b, c), low))

    return cost


def test_model_matches_brute_force(spark):
    rng = random.Random(9)
    trusted = Counter((rng.randrange(4), rng.randrange(6), rng.randrange(9)) for _ in range(400))
    grams = [(a, b, c) for a in range(5) for b in range(7) for c in range(10)]
    rows = [(kneser_ney.gram_code(*g), 1, trusted.get(g, 0)) for g in grams]
    costs = kneser_ney.log_probabilities(spark.createDataFrame(rows, "code long, n long, trusted long"))
    got = {r["code"]: r["cost"] / kneser_ney.UNIT for r in costs.collect()}
    brute = brute_kneser_ney({g: n for g, n in trusted.items()}, kneser_ney.SYMBOLS)
    assert all(abs(got[kneser_ney.gram_code(*g)] - brute(*g)) < 1e-5 for g in grams)


def test_perplexity_is_that_of_the_whole_text(spark, docs):
    rng = random.Random(10)
    good = ["the cat sat on the mat and ate " * rng.randrange(1, 9) for _ in range(80)]
    texts = [*good, "x#z$q%" * 50, "", None, "the " * 3000]
    df = docs(texts)
    trusted = df.filter("doc_id < 80").select("doc_id")
    got = {r["doc_id"]: r for r in kneser_ney.perplexities(df, trusted).collect()}
    points = kneser_ney.alphabet(df)
    symbol = {chr(c): i + 2 for i, c in enumerate(points)}
    counts = Counter()
    grams = []
    for i, text in enumerate(texts):
        s = [0, 0, *[symbol[c] for c in text or ""], 0]
        grams.append(list(zip(s, s[1:], s[2:], strict=False)))
        counts.update(grams[-1] if i < 80 else [])
    brute = brute_kneser_ney(counts, kneser_ney.SYMBOLS)
    seen = {g: brute(*g) for g in {g for part in grams for g in part}}
    for i, part in enumerate(grams):
        assert got[i]["n"] == len(part)
        assert math.isclose(got[i]["perplexity"], math.exp(sum(seen[g] for g in part) / len(part)), rel_tol=1e-4)
    assert not got[80]["kept"] and all(got[i]["kept"] for i in (*range(80), 81, 82))


def test_held_out_labels(spark, sample):
    sample = sample.replace("sf0.001", "sf0.01")
    df = spark.read.parquet(f"{sample}/documents.parquet")
    labels = spark.read.parquet(f"{sample}/labels.parquet")
    learnt = labels.filter("quality = 1 AND toxic = 0 AND doc_id % 2 = 0").select("doc_id")
    judged = kneser_ney.perplexities(df, learnt).join(labels.filter("doc_id % 2 = 1"), "doc_id").collect()
    bad = [r["kept"] for r in judged if r["quality"] == 0]
    good = [r["kept"] for r in judged if r["quality"] == 1]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.2 * len(bad)


def test_raking_meets_the_targets(spark):
    rng = random.Random(11)
    rows = [(f"s{i}", f"l{j}", rng.randrange(1, 1000)) for i in range(6) for j in range(4)]
    cells = spark.createDataFrame(rows, "source string, lang string, _tokens long")
    wanted = {"source": {f"s{i}": (i + 1) / 21 for i in range(6)}, "lang": {"l0": 0.4, "l1": 0.3, "l2": 0.2, "l3": 0.1}}
    tables = {d: spark.createDataFrame(list(t.items()), f"{d} string, _target double") for d, t in wanted.items()}
    for limit in (0, 100):
        got = mixing.rake(cells, tables, limit).collect()
        for dim, shares in wanted.items():
            for value, share in shares.items():
                assert math.isclose(sum(r["_weight"] for r in got if r[dim] == value), share, rel_tol=1e-4)
    # The same as proportional fitting by hand.
    weight = {r[:2]: float(r[2]) for r in rows}
    for _ in range(400):
        for k, shares in enumerate(wanted.values()):
            sums = defaultdict(float)
            for cell, w in weight.items():
                sums[cell[k]] += w
            weight = {c: w * shares[c[k]] / sums[c[k]] for c, w in weight.items()}
    assert all(math.isclose(r["_weight"], weight[r["source"], r["lang"]], rel_tol=1e-3) for r in got)


def test_sample_follows_the_rates(spark, docs):
    many = docs([(i, "w " * 10) for i in range(4000)], source="big").unionByName(docs([(9000 + i, "w " * 10) for i in range(1000)], source="small"))
    targets = {"source": spark.createDataFrame([("big", 0.5), ("small", 0.5)], "source string, _target double")}
    mixed = mixing.mix(many, {"source": F.col("source")}, targets, seed=1)
    kept = Counter(r["source"] for r in mixed.filter("kept").collect())
    assert kept["small"] == 1000 and 850 < kept["big"] < 1150
    again = Counter(r["source"] for r in mixing.mix(many.repartition(7), {"source": F.col("source")}, targets, seed=1).filter("kept").collect())
    assert kept == again


def test_what_scarce_cells_lack_is_handed_on(spark):
    rows = [("a", 1000, 0.2), ("b", 100, 0.4), ("c", 10, 0.4), ("d", 5, 0.0)]
    cells = spark.createDataFrame(rows, "name string, _tokens long, _weight double")
    for budget in (1.0, 20.0, 300.0, 900.0, 1109.0, 5000.0):
        got = {r["name"]: r["probability"] for r in mixing.sampling_rates(cells, budget).collect()}
        assert math.isclose(sum(n * got[name] for name, n, _ in rows), min(budget, 1110), rel_tol=1e-9)
        assert got["d"] == 0 and max(got.values()) <= 1
        free = [name for name, n, w in rows if w and got[name] < 1]
        assert len({round(got[name] * n / w, 6) for name, n, w in rows if name in free}) <= 1


def test_one_odd_document_changes_little(spark, docs):
    many = docs([(i, "w " * 10) for i in range(3000)], source="big").unionByName(docs([(5000 + i, "w " * 10) for i in range(1000)], source="small"))
    odd = many.unionByName(docs([(9999, "Zeile")], lang="xx", source="odd"))
    dims = {"source": F.col("source"), "lang": F.col("lang")}
    kept = [mixing.sample(df, dims, 0.8, 7, 0.8).count() for df in (many, odd)]
    assert abs(kept[1] - kept[0]) < 0.01 * 4000 and abs(kept[0] - 3200) < 100


def test_topics_by_what_a_text_is_made_of(column):
    texts = [
        "A plain sentence, written out in full, that goes on for a while and has its marks. " * 3,
        "name | age | place\n" * 20, "2024 11 05 77 120 9\n" * 20, "<a href='x'>{b}</a> = [c];" * 9, "milk\nbread\neggs\n" * 9, " ", None,
    ]
    assert column(texts, "string", mixing.content_topic) == ["prose", "records", "figures", "markup", "lists", "empty", "empty"]


def test_rows_that_are_alike_are_numbered_apart(spark, docs, monkeypatch):
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 7)
    rows = [(None, None)] * 60 + [(1, "a")] * 25 + [(i, f"t{i}") for i in range(2, 60)]
    got = sharding.assign_shards(docs(rows).repartition(3), 16, 5).collect()
    assert sorted(r["row_number"] for r in got) == list(range(len(rows)))
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, _ in rows)


def test_rare_scripts_are_told_apart(spark, docs):
    """Cyrillic beside a Latin text with more characters than 64: garbage in it goes, clean text stays."""
    rng = random.Random(12)
    latin = ["".join(rng.choices([chr(c) for c in range(0x21, 0x7F)], k=4000)) for _ in range(30)]
    words = "мама мыла раму а папа читал газету и пил чай с молоком".split()
    good = [" ".join(rng.choices(words, k=60)) for _ in range(120)]
    garbage = ["".join(rng.sample(text, len(text))) for text in good[100:]]
    df = docs(latin).unionByName(docs([(100 + i, t) for i, t in enumerate([*good, *garbage])], lang="ru"))
    got = {r["doc_id"]: r for r in kneser_ney.perplexities(df, df.filter("doc_id < 200").select("doc_id")).collect()}
    assert sum(got[i]["kept"] for i in range(100, 220)) >= 118 and not any(got[i]["kept"] for i in range(220, 240))
    assert len(kneser_ney.alphabet(df)) == len(set("".join([*latin, *good])))


def test_shards_grow_with_the_model(docs, monkeypatch):
    rng = random.Random(13)
    df = docs(["".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(300)) for _ in range(40)])
    trusted = df.filter("doc_id < 30").select("doc_id")
    before = {r["doc_id"]: (r["n"], r["perplexity"]) for r in kneser_ney.perplexities(df, trusted).collect()}
    monkeypatch.setattr(kneser_ney, "SHARD_GRAMS", 500)
    monkeypatch.setattr(kneser_ney, "BLOCK_DOCS", 20)
    assert before == {r["doc_id"]: (r["n"], r["perplexity"]) for r in kneser_ney.perplexities(df, trusted).collect()}


def test_threshold_is_the_quantile_of_held_out_trusted_text(docs):
    """Of trusted texts one in a hundred goes, and texts that repeat one phrase go with them."""
    rng = random.Random(14)
    words = ["".join(rng.choices("abcdefghijklmnopqrst", k=rng.randrange(2, 9))) for _ in range(400)]
    good = [" ".join(rng.choices(words, k=80)) for _ in range(300)]
    odd = [" ".join(["".join(rng.choices("abcdefghijklmnopqrst", k=12)) for _ in range(45)]) for _ in range(20)]
    df = docs([*good, *odd])
    got = {r["doc_id"]: r for r in kneser_ney.perplexities(df, df.filter("doc_id < 300").select("doc_id")).collect()}
    assert sum(not got[i]["kept"] for i in range(300)) == 3 and not any(got[i]["kept"] for i in range(300, 320))
    entropies = sorted(got[i]["entropy"] for i in range(300))
    assert entropies[296] <= got[0]["threshold"] <= entropies[296] + 0.0011
    assert all(got[i]["entropy"] > math.log(got[i]["perplexity"]) for i in range(300))
