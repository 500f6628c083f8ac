import hashlib
import random
import re
from collections import defaultdict

import xxhash
from pyspark.sql import functions as F

from outfall.llm import exact_dedup, sentence_spans, simhash


def brute_copies(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(i)
    return {i: (min(ids), len(ids), hashlib.sha256(n.encode()).hexdigest()) for n, ids in groups.items() for i in ids}


def some_rows(n=300, seed=1):
    rng = random.Random(seed)
    texts = ["".join(rng.choice("ab \n\t é") for _ in range(rng.randrange(7))) for _ in range(n)]
    return [(i, rng.choice([t, t, None])) for i, t in enumerate(texts)] + [(1000 + i, "hot  copy") for i in range(n)]


def test_copies_match_brute_force(docs):
    rows = some_rows()
    expected = brute_copies(rows)
    # A hash of one hex digit collides all the time; the bytes must tell the texts apart.
    weak = lambda text: F.substring(F.md5(text.cast("binary")), 1, 1)
    for options in ({}, {"digest": weak}, {"max_rows": 0}):
        got = exact_dedup.mark_copies(docs(rows), **options).collect()
        assert len(got) == len(rows)
        for r in got:
            assert (r["keep_id"], r["group_size"], r["text_sha256"]) == expected[r["doc_id"]]
            assert r["kept"] == (r["doc_id"] == r["keep_id"])


def test_dropped_copies(docs):
    rows = [(1, "a  b"), (2, "a b"), (3, "c"), (3, "c"), (None, "c"), (None, "d"), (None, "d"), (5, None), (6, "")]
    for limit in (0, 100):
        got = exact_dedup.drop_copies(docs(rows, clashes=True), limit)
        assert got.columns == docs([], clashes=True).columns
        assert sorted((r["doc_id"] or 0, r["text"]) for r in got.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).collect()) == [
            (0, "d"), (1, "a  b"), (3, "c"), (5, ""),
        ]


def brute_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    words = [bytes(c + 32 if 65 <= c <= 90 else c for c in w) for w in words]
    if not words:
        return 0
    parts = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, bits=2):
    parent = {i: i for i in prints}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(prints)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= bits:
                ra, rb = root(a), root(b)
                parent[max(ra, rb)] = min(ra, rb)
    return {i: root(i) for i in ids}


def test_fingerprints(spark):
    same = spark.sql("SELECT xxhash64('a b c')").first()[0] % (1 << 64)
    assert simhash.fingerprint("A b\tC") == same  # one shingle: its own hash
    rng = random.Random(3)
    for _ in range(200):
        text = " ".join(rng.choice(["a", "B", "É", "cc", " "]) for _ in range(rng.randrange(12)))
        assert simhash.fingerprint(text) == brute_fingerprint(text)
    assert simhash.fingerprint(None) == 0


def test_links_match_brute_force_in_cold_and_full_buckets(spark):
    rng = random.Random(5)
    near = set()
    for _ in range(12):
        at = rng.getrandbits(64)
        for _ in range(25):  # chains of small steps
            near.add(at)
            for _ in range(rng.choice([1, 2, 2, 3])):
                at ^= 1 << rng.randrange(64)
    signed = {p: p - (1 << 64) if p >> 63 else p for p in near}
    prints = spark.createDataFrame([(s,) for s in signed.values()], "fp long")
    expected = brute_components({s: p for p, s in signed.items()})
    for pair_bucket in (0, 3, 1000):
        edges = simhash.links(prints, pair_bucket)
        assert all(((r["a"] ^ r["b"]) & (1 << 64) - 1).bit_count() <= 2 for r in edges.collect())
        roots = {r["node"]: r["root"] for r in simhash.components(edges).collect()}
        assert {i: roots.get(i, i) for i in expected} == expected


def test_near_copies_of_the_sample(spark, sample):
    df = spark.read.parquet(f"{sample}/documents.parquet")
    prints = {r["doc_id"]: brute_fingerprint(r["text"]) for r in df.collect()}
    expected = brute_components(prints)
    got = simhash.near_copies(df).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == expected
    assert {r["doc_id"]: r["fp"] % (1 << 64) for r in got} == prints
    kept = {r["doc_id"] for r in simhash.drop_near_copies(df).collect()}
    assert kept == {i for i, c in expected.items() if i == c}


def long_enough(parts):
    words = " ".join(parts).encode().split()
    return len(words) >= sentence_spans.LEAST_WORDS or len("".join(w.decode() for w in words)) >= sentence_spans.LEAST_CHARS


def test_short_notices_and_other_scripts(docs):
    notice = "This site uses cookies for preferences and statistics. Accept all the cookies or choose your settings now!"
    chinese = "本网站使用小甜饼来改善您的浏览体验并统计访问量以便我们不断改进服务质量请您仔细阅读以下条款内容。继续浏览即表示您同意我们使用小甜饼以及我们的隐私政策和服务条款的全部内容感谢您的理解。"
    rows = [(i, f"Something of its own, number {i * 7919}. {notice} The end of page {i * 104729} is here.") for i in range(3)]
    rows += [(10 + i, f"第{i * 7919}页的内容完全不同。{chinese}第{i * 104729}页到此为止。") for i in range(3)]
    got = {r["doc_id"]: r["text"] for r in sentence_spans.cleaned(docs(rows)).collect()}
    assert set(got) == {1, 2, 11, 12}
    assert all("cookies" not in got[i] and str(i * 7919) in got[i] and str(i * 104729) in got[i] for i in (1, 2))
    assert all("小甜饼" not in got[i] and "到此为止" in got[i] for i in (11, 12))


def test_sentences_end_where_they_did():
    plain = re.compile(r"[^\n]*?(?:[.!?](?=[\x20\x09-\x0D])|[\u3002\uFF01\uFF1F\u0964\u061F]|\n|\Z)", re.S)
    rng = random.Random(9)
    for _ in range(2000):
        text = "".join(rng.choice("ab .!?\n\r\t\u3002\u061f1") for _ in range(rng.randrange(30)))
        assert [m.span() for m in sentence_spans._SENTENCE.finditer(text)] == [m.span() for m in plain.finditer(text)]


def test_runs_of_many_shards(spark, docs, monkeypatch):
    rows = [(i, f"Words number {i % 7} of this text are many enough to count. And so are these, all {i % 7} of them, by far.") for i in range(50)]
    one = sentence_spans.repeated_spans(docs(rows)).collect()
    many = sentence_spans.repeated_spans(docs(rows).repartition(9)).collect()
    assert sorted(map(repr, one)) == sorted(map(repr, many)) and len(one) == 43


def test_sentence_spans_match_brute_force(spark, sample):
    df = spark.read.parquet(f"{sample}/documents.parquet")
    texts = dict(sorted((r["doc_id"], r["text"]) for r in df.collect()))
    first, spans = {}, defaultdict(list)
    for i, text in texts.items():
        parts = [p[2] for p in sentence_spans.sentences(text)]
        assert " ".join(parts).encode() == b" ".join(text.encode().split())
        for a in range(len(parts)):
            ends = range(a + sentence_spans.LEAST_SENTENCES, len(parts) + 1)
            run = next(((b, " ".join(parts[a:b])) for b in ends if long_enough(parts[a:b])), None)
            if run and first.setdefault(run[1], (i, a)) != (i, a):
                spans[i].append((a, run[0]))
    for limit in (0, 1000):
        got = sentence_spans.cleaned(df, limit).collect()
        assert {r["doc_id"] for r in got} == set(spans)
        for r in got:
            assert r["text"] == sentence_spans.cut_out(texts[r["doc_id"]], spans[r["doc_id"]])[0]


def test_a_shared_passage_is_cut_once(docs):
    rng = random.Random(2)
    words = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(n))
    passage = f"{words(22)}. {words(21)}. {words(18)}."
    rows = [(i, f"{words(30)}.\n{passage}\n{words(25)}.") for i in range(3)] + [(9, f"{words(80)}.")]
    got = {r["doc_id"]: r for r in sentence_spans.cleaned(docs(rows)).collect()}
    assert set(got) == {1, 2} and all(r["first_doc_ids"] == [0] for r in got.values())
    assert all(passage[:40] not in r["text"] and rows[r["doc_id"]][1][:100] in r["text"] for r in got.values())


def test_a_passage_within_a_sentence_is_found_at_every_offset(docs):
    """50 to 70 words without a mark, planted anywhere in longer sentences."""
    rng = random.Random(15)
    words = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(n))
    rows, sizes = [], {}
    for size in (50, 60, 70):
        for offset in range(13):
            passage = words(size)
            rows += [(2 * len(sizes), f"{words(30)} {passage} {words(30)}."), (2 * len(sizes) + 1, f"{words(30 + offset)} {passage} {words(25)}.")]
            sizes[2 * len(sizes) + 1] = (size, offset)
    got = {r["doc_id"]: r for r in sentence_spans.cleaned(docs(rows)).collect()}
    assert set(got) == set(sizes)
    lost = [size + 55 + offset - len(got[i]["text"].split()) for i, (size, offset) in sizes.items()]
    assert all(sentence_spans.LEAST_CHARS // 5 <= n <= size for n, (size, _) in zip(lost, sizes.values(), strict=True))
    assert sum(lost) >= 0.7 * sum(size for size, _ in sizes.values())
