"""Quality rules on repetition: how much of a text lies in repeated n-grams and repeated lines.

Words are numbered, and the hash of a window of n words rolls on to that of n + 1 words by one
multiplication and one addition over whole arrays. Windows whose hash came before in the same
document are marked, and the characters of the words under any marked window are counted.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outfall.llm.words import WORD

#: Most share of a text's word characters that may lie in n-grams that came before, by n.
MOST_REPEATED = {5: 0.25, 6: 0.24, 8: 0.22, 10: 0.20}
#: Most share of the lines that may be repeats, and of the word characters in them.
MOST_REPEATED_LINES = 0.40
MOST_REPEATED_LINE_CHARS = 0.25
#: The fixed rules: least words, the window, and the share of words in repeated windows.
LEAST_WORDS = 20
WINDOW = 8
MOST_REPEATED_WORDS = 0.30
#: Characters of text whose words are handled at once. A longer text is handled alone.
SLICE_CHARS = 4_000_000
_WORDS = re.compile(WORD)
_SYMBOLS = re.compile(r"[#*$%&|<>]")
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _repeats(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places whose hash came before, and places of first occurrences that come again."""
    order = np.argsort(hashes, kind="stable")
    ranked = hashes[order]
    same = ranked[1:] == ranked[:-1]
    later = order[1:][same]
    first = np.ones(len(hashes), bool)
    first[later] = False
    sources = order[:-1][same]
    return later, sources[first[sources]]


def _under(starts: np.ndarray, n: int, size: int) -> np.ndarray:
    marks = np.bincount(starts, minlength=size + 1) - np.bincount(starts + n, minlength=size + 1)[: size + 1]
    return np.cumsum(marks[:size]) > 0


def covered_words(
    ids: np.ndarray, doc: np.ndarray, lengths: list[int]
) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For each n: which words lie in an n-word window that came before in the same document, and
    which in a window that the document has twice or more, the first included.

    ``ids`` are word numbers, ``doc`` the document of each word, in ascending order.
    """
    value = _mixed(ids.astype(np.uint64) + np.uint64(1))
    salt = _mixed(~doc.astype(np.uint64))
    rolled = value.copy()
    covered = {}
    for n in range(2, max(lengths) + 1):
        if len(rolled) < 2:
            rolled = rolled[:0]
        else:
            rolled = rolled[:-1] * _BASE + value[n - 1 :]
        if n not in lengths:
            continue
        inside = np.flatnonzero(doc[: len(rolled)] == doc[n - 1 :]) if len(rolled) else np.zeros(0, np.int64)
        later, firsts = _repeats(rolled[inside] ^ salt[inside])
        under = _under(inside[later], n, len(ids))
        covered[n] = under, under | _under(inside[firsts], n, len(ids))
    return covered


def measure(texts: list[str]) -> dict[str, np.ndarray]:
    """All measures of the texts, by name."""
    found = [_WORDS.findall(t) for t in texts]
    n_words = np.array([len(w) for w in found], np.int64)
    doc = np.repeat(np.arange(len(texts)), n_words)
    words = [w for part in found for w in part]
    number: dict[str, int] = defaultdict(count().__next__)
    ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    chars = np.fromiter(map(len, words), np.int64, len(words))
    lengths = sorted({*MOST_REPEATED, WINDOW})
    with np.errstate(over="ignore"):
        covered = covered_words(ids, doc, lengths)

    def per_doc(weights: np.ndarray) -> np.ndarray:
        return np.bincount(doc, weights, len(texts)).astype(np.int64)

    lines = np.array([_repeated_lines(t) for t in texts], np.int64).reshape(-1, 3)
    result = {
        "n_words": n_words,
        "word_chars": per_doc(chars),
        "n_symbols": np.array([len(_SYMBOLS.findall(t)) for t in texts], np.int64),
        "n_dup_lines": lines[:, 1],
        "n_repeat_words": per_doc(covered[WINDOW][1]),
        "n_lines": lines[:, 0],
        "dup_line_chars": lines[:, 2],
    }
    return result | {f"dup_{n}gram_chars": per_doc(covered[n][0] * chars) for n in MOST_REPEATED}


def _repeated_lines(text: str) -> tuple[int, int, int]:
    """Lines with a word, those equal to an earlier one, and the word characters of these."""
    seen = set()
    n = repeats = chars = 0
    for line in text.split("\n"):
        if line in seen:
            n, repeats = n + 1, repeats + 1
            chars += sum(map(len, _WORDS.findall(line)))
        elif _WORDS.search(line):
            n += 1
            seen.add(line)
    return n, repeats, chars


def verdict(m: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Which texts fail the fixed rules, and which are kept."""
    failed = (m["n_words"] < LEAST_WORDS) | (100 * m["n_repeat_words"] > round(100 * MOST_REPEATED_WORDS) * m["n_words"])
    bad = m["n_dup_lines"] > MOST_REPEATED_LINES * m["n_lines"]
    bad |= m["dup_line_chars"] > MOST_REPEATED_LINE_CHARS * m["word_chars"]
    for n, most in MOST_REPEATED.items():
        bad |= m[f"dup_{n}gram_chars"] > most * m["word_chars"]
    return failed, ~(failed | bad)


MEASURES = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "dup_line_chars",
    *[f"dup_{n}gram_chars" for n in MOST_REPEATED],
]


def repetition(docs: DataFrame) -> DataFrame:
    """``doc_id``, the measures, ``base_failed`` and ``kept`` for every row of ``docs``.

    Null texts have no words, and so fail. Other columns are not read. Rows that repeat come back
    as often. A line that consists of white space alone is not counted.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py() or "" for t in batch.column(1)]
            for begin, end in _slices(texts):
                m = measure(texts[begin:end])
                failed, kept = verdict(m)
                columns = [batch.column(0).slice(begin, end - begin), *[pa.array(m[c]) for c in MEASURES]]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(failed), pa.array(kept)], names)

    names = ["doc_id", *MEASURES, "base_failed", "kept"]
    ids = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {ids}, {', '.join(f'{c} long' for c in MEASURES)}, base_failed boolean, kept boolean"
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, schema)


def _slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    begin, size = 0, 0
    for i, text in enumerate(texts):
        if i > begin and size + len(text) > SLICE_CHARS:
            yield begin, i
            begin, size = i, 0
        size += len(text)
    if begin < len(texts):
        yield begin, len(texts)
