import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from outfall.llm import bpe, token_files
from outfall.llm.queries import tokenizer_path
from outfall.llm.token_files import EliasFano, Segment
from outfall.session import shared_dir


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(tokenizer_path())
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


ODD = [
    "", " ", "don't I'll 'S", "<|endoftext|>a<|startoftext|> x<|endoftext|", "İstanbul ΣΑΣ á ẞ ﬁ １２ ½", "\x1cq\x00w\x85v x",
    "日本語 テスト 한국어 🎉👩‍👩‍👧 naïve", "a" * 4000 + " " + "1" * 300 + "!" * 300, "́ ﻿Hi​there",
]


def agrees(text, library):
    ids = library.encode(text, add_special_tokens=False).ids
    coder, other = bpe.encoder(tokenizer_path()), token_files.library_encoder(tokenizer_path())
    assert coder.encode(text) == ids and coder.decimals(text)[1] == library.decode(ids, skip_special_tokens=False)
    assert np.frombuffer(other.encode(text), np.uint16).tolist() == ids


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(text, library):
    agrees(text, library)


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(max_codepoint=0x24F)) | st.text(st.sampled_from("aéΣ '<|>́ 12日ß\n")))
def test_any_text(library, text):
    agrees(text, library)


def test_arrays_and_back(docs):
    df = bpe.with_decoded(bpe.with_ids(docs(["Hello, world", None, ""]), tokenizer_path()), tokenizer_path())
    got = {r["doc_id"]: (r["ids"], r["decoded"]) for r in df.collect()}
    assert got[1] == got[2] == ([], "") and got[0][1] == "hello</w> ,</w> world</w>"


def test_digests_of_the_sample(spark, sample, library):
    df = spark.read.parquet(f"{sample}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in df.collect()}
    for r in bpe.encode_digests(df, tokenizer_path()).collect():
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


@pytest.mark.parametrize("segment_ids", [1, 5_000, 10**9])
def test_files_of_the_sample(spark, sample, library, segment_ids):
    df = spark.read.parquet(f"{sample}/documents.parquet")
    to = shared_dir(spark)
    token_files.write_tokens(df.repartition(5), tokenizer_path(), to, 1, segment_ids)
    got = {r["doc_id"]: r for r in token_files.read_documents(spark, to).collect()}
    start = 0
    for i, text in sorted((r["doc_id"], r["text"]) for r in df.collect()):
        ids = [*library.encode(text, add_special_tokens=False).ids, 1]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert (got[i]["start"], got[i]["n_tokens"], got[i]["ids_crc32"]) == (start, len(ids), crc)
        start += len(ids)


def test_elias_fano_round_trip():
    rng = random.Random(1)
    cases = [[], [0], [5], [0, 0, 0, 7, 7, 900, 10**12], [2**63], sorted(rng.randrange(10**6) for _ in range(3000))]
    for values in cases:
        packed = EliasFano.of(np.array(values, np.uint64)).to_bytes()
        back, rest = EliasFano.from_bytes(memoryview(packed + b"rest"))
        assert back.values().tolist() == values and bytes(rest) == b"rest"
        assert [back.select(i) for i in range(len(values))] == values
    with pytest.raises(IndexError):
        back.select(3000)
    # Near-minimal: about two bits and the low ones for each, far below 64.
    assert 8 * len(packed) / 3000 < 3 + np.log2(10**6 / 3000)


def test_segment_gives_any_document():
    arrays = [np.arange(n, dtype=np.uint16) for n in (3, 0, 5)]
    blob = token_files.pack_segment([None, -4, 900], [a.tobytes() for a in arrays], 2)
    segment = Segment(blob)
    assert segment.doc_ids == [None, -4, 900]
    assert [segment.document(i).tolist() for i in range(3)] == [a.tolist() for a in arrays]
    with pytest.raises(ValueError):
        Segment(b"XXXX" + blob[4:])
