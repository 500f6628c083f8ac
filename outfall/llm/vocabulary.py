"""A tokenizer file with word ends: its vocabulary, its merges, and how it cuts a text into pieces.

The file's steps are: composed form, lower case, pieces by a pattern, bytes as printable
characters, merges. White space separates pieces and is dropped. No merge crosses pieces, so a piece
that was seen before can be looked up.

Letters and digits are told apart by the regex module's Unicode tables. For characters that Unicode
16 or later added, these may differ from the tables of the library.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable
from functools import lru_cache

import regex

#: Unicode white space, as the pattern's class has it.
_SPACES = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Pieces that a worker remembers, in each of two generations.
CACHED = 150_000


class Vocabulary:
    """What a file of this kind holds. Files with other steps are refused."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            held = json.load(file)
        model = held["model"]
        steps = [n["type"] for n in held["normalizer"]["normalizers"]]
        cut = held["pre_tokenizer"]["pretokenizers"][0]
        if (
            model["type"] != "BPE"
            or steps != ["NFC", "Replace", "Lowercase"]
            or cut["type"] != "Split"
            or not cut["invert"]
            or held["decoder"] is not None
            or held["post_processor"] is not None
        ):
            raise ValueError(f"{path} is not a byte-pair file with word ends")
        self.ids: dict[str, int] = model["vocab"]
        self.word_end: str = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in held["added_tokens"]}
        self.strings = {i: s for s, i in self.ids.items()} | {i: s for s, i in self.special.items()}
        #: left id << 32 | right id: rank; and by rank the id of the merged symbol
        self.ranks: dict[int, int] = {}
        self.merged: list[int] = []
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.ranks[self.ids[left] << 32 | self.ids[right]] = rank
            self.merged.append(self.ids[left + right])
        pattern = cut["pattern"]["Regex"]
        self.pieces = regex.compile(_replaced(pattern, {"\\s": _SPACES}))
        #: The same for lowered ASCII text.
        self.ascii_pieces = re.compile(_replaced(pattern, {"\\p{L}": "a-z", "\\p{N}": "0-9", "\\s": "\\t-\\r "}))
        self.specials = regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)))
        self.bytes_as = _printable_bytes()

    def split(self, text: str) -> list[str | int]:
        """The pieces of a text, bytes as printable characters, and ids of special tokens in it."""
        if "<" not in text or not self.special:
            return self._plain(text)
        found: list[str | int] = []
        at = 0
        for m in self.specials.finditer(text):
            found += self._plain(text[at : m.start()])
            found.append(self.special[m.group()])
            at = m.end()
        return found + self._plain(text[at:])

    def _plain(self, text: str) -> list[str]:
        if text.isascii():
            return self.ascii_pieces.findall(text.lower())
        text = unicodedata.normalize("NFC", text)
        if "\u03a3" in text:
            # The library lowers letter by letter, so the end of a word has no sigma of its own.
            text = text.replace("\u03a3", "\u03c3")
        return self.pieces.findall(text.lower())

    def symbols(self, piece: str) -> str:
        """A piece with its bytes as printable characters."""
        if piece.isascii() and piece.isprintable():
            return piece
        return piece.encode().decode("latin-1").translate(self.bytes_as)


def _replaced(pattern: str, parts: dict[str, str]) -> str:
    for old, new in parts.items():
        pattern = pattern.replace(old, new)
    return pattern


def _printable_bytes() -> dict[int, int]:
    """Bytes that are printable in Latin-1 stand for themselves, the others follow from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: b for b in shown} | {b: 256 + i for i, b in enumerate(hidden)}


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    """The file at ``path``, read once per worker process."""
    return Vocabulary(path)


class Remembered:
    """A function of one key with a bounded memory: what the last two generations asked for."""

    def __init__(self, make: Callable, size: int = CACHED):
        self.make, self.size = make, size
        self.young: dict = {}
        self.old: dict = {}

    def __call__(self, key):
        value = self.young.get(key)
        if value is None:
            value = self.old.get(key)
            if value is None:
                value = self.make(key)
            if len(self.young) >= self.size:
                self.old, self.young = self.young, {}
            self.young[key] = value
        return value

    def all(self, keys: list) -> list:
        """The values of many keys. ``make`` never returns None."""
        values = list(map(self.young.get, keys))
        at = -1
        try:
            while True:
                at = values.index(None, at + 1)
                values[at] = self(keys[at])
        except ValueError:
            return values
