"""Stretches of text whose tokens do not depend on what stands around them, and byte-level ids remembered per stretch."""

from __future__ import annotations

import os
import re
import sys
from array import array

import numpy as np
from tokenizers import Tokenizer

#: White space other than the two characters that texts mostly have.
_RARE_SPACE = re.compile(r"[^\S \n]")
_CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
#: Units a worker remembers, twice: when so many are new, what was remembered before the last such time goes.
REMEMBERED = 450_000


def units(text: str) -> list[str]:
    """``text`` cut before every blank or line feed that stands alone between two other characters; the blanks go.

    So the units behind the first stand for themselves if they begin with a line feed, else for themselves behind a blank.
    Byte-level pre-tokens take at most the last character of a run of white space into the next word, and no piece of a
    vocabulary whose word mark stands in front spans such a place either, so the units' tokens are the text's.
    """
    if _RARE_SPACE.search(text) is None:
        words = text.replace("\n", " \n").split(" ")
        if "" not in words and "\n" not in words:
            return words
    first, *others = _CUT.split(text)
    return [first, *[u[1:] if u[0] == " " else u for u in others]]


def spelled(unit: str) -> str:
    """A unit behind the first as it stands in the text."""
    return unit if unit[0] in " \n" else " " + unit


def stem_and_marks(unit: str) -> tuple[str, str]:
    """``unit`` without the ASCII marks it ends with, and those; ("", unit) if no letter or digit stands before them."""
    stem = unit.rstrip(MARKS)
    if stem and stem != unit and (stem[-1].isalpha() or "0" <= stem[-1] <= "9"):
        return stem, unit[len(stem):]
    return "", unit


def byte_alphabet() -> dict[int, str]:
    """The printable character that byte-level vocabularies use for each byte, as a table for str.translate."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}


def one_thread() -> None:
    """Tokenizers in a task use its core only."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"


class ByteLevel:
    """A byte-level tokenizer file: ids of units, and the bytes of each id.

    ``plain`` takes the special tokens' strings inside a text as ordinary text.
    """

    def __init__(self, tokenizer_file: str, plain: bool) -> None:
        one_thread()
        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.tokenizer.encode_special_tokens = plain
        self.model = self.tokenizer.model
        #: Whether a special token's string may be in a stretch of text.
        self.special = re.compile("(?!)" if plain else "|".join(
            re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()) or "(?!)")
        self.alphabet = byte_alphabet()
        self.line_feed = self.whole("\n")

    def ids(self, text: str) -> list[int]:
        """Ids of a stretch of text that starts and ends where pre-tokens do."""
        word = text[1:] if text[0] == " " else text
        if word.isalpha():  # one pre-token: straight from the merges
            coded = text.encode().decode("latin-1").translate(self.alphabet)
            return [t.id for t in self.model.tokenize(coded)]
        if text[0] == "\n" and len(text) > 1 and text[1:].isalpha():
            return [*self.line_feed, *self.ids(text[1:])]
        return self.whole(text)

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def id_bytes(self) -> list[bytes]:
        back = {ord(c): b for b, c in self.alphabet.items()}
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        return [bytes(back[ord(c)] for c in self.tokenizer.id_to_token(i) or "") for i in range(size)]


class PackedIds(dict):
    """Ids of units behind the first as little-endian unsigned 32-bit integers; one asked for the first time is encoded."""

    def __init__(self, tokenizer_file: str) -> None:
        super().__init__()
        self.level = ByteLevel(tokenizer_file, plain=False)
        self.older: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {}

    def _packed(self, text: str) -> bytes:
        ids = self.level.ids(text) if text else []
        return array("I", ids).tobytes() if sys.byteorder == "little" else np.array(ids, dtype="<u4").tobytes()

    def _behind(self, marks: str) -> bytes:
        if marks not in self.marks and len(self.marks) < REMEMBERED:
            self.marks[marks] = self._packed(marks)
        return self.marks.get(marks) or self._packed(marks)

    def __missing__(self, unit: str) -> bytes:
        found = self.older.get(unit)
        if found is None:
            stem, rest = ("", unit) if unit[-1].isalpha() or self.level.special.search(unit) else stem_and_marks(unit)
            if stem:
                seen = stem in self
                found = self[stem] + self._behind(rest)
                if not seen:  # remember only what is likely to come again
                    return found
            else:
                found = self._packed(spelled(unit))
        if len(self) >= REMEMBERED:
            self.older = dict(self)
            self.clear()
        self[unit] = found
        return found

    def encode(self, text: str) -> bytes:
        first, *others = units(text)
        return self._packed(first) + b"".join(map(self.__getitem__, others))


_encoders: dict[str, PackedIds] = {}


def packed_ids(tokenizer_file: str) -> PackedIds:
    """This worker's encoder; it outlives a task, so later tasks find its units."""
    if tokenizer_file not in _encoders:
        _encoders[tokenizer_file] = PackedIds(tokenizer_file)
    return _encoders[tokenizer_file]
