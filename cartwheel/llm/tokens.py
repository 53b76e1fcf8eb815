"""Whole texts to token ids, as packed little-endian unsigned 32-bit numbers.

The tokenizer lower-cases, cuts a text into words, single digits and runs of
other signs, and encodes each of those on its own. Such units repeat heavily,
so each worker keeps the ids of the units it has met; the library encodes
every new one with its model. Texts in which a library could see characters differently
(anything outside printable Latin-1) or that may hold a special token's
string are encoded whole by the library.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from array import array

from tokenizers import Tokenizer

_WHITE = "\x09-\x0d\x20"
_LATIN = [chr(c) for c in [*range(0x21, 0x7F), *range(0xA1, 0x100)]]


def _class(first: str) -> str:
    """The Latin-1 characters of a Unicode class after lower-casing, for a regular expression."""
    return "".join(re.escape(c) for c in _LATIN if unicodedata.category(c)[0] == first and c == c.lower())


_LETTER, _NUMBER = _class("L"), _class("N")
#: The contractions and classes of the vocabulary's own pattern.
_UNIT = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^{_WHITE}{_LETTER}{_NUMBER}]+")
_KNOWN = bytes([*range(0x09, 0x0E), 0x20, *range(0x21, 0x7F), *range(0xA1, 0x100)])
#: The byte-level alphabet: printable bytes stand for themselves, the others,
#: in order, for the characters from U+0100 on.
_PLAIN = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_BYTE = {b: chr(b) for b in _PLAIN} | {b: chr(0x100 + i) for i, b in enumerate(b for b in range(256) if b not in _PLAIN)}
#: Units kept per worker in each of two generations (about 200 bytes each).
KEPT_UNITS = 300_000
LONGEST_KEPT = 64


def _plain(text: str) -> bool:
    """Whether only characters occur for which the units below are the tokenizer's own."""
    try:
        return not text.encode("latin-1").translate(None, _KNOWN) and "<|" not in text
    except UnicodeEncodeError:
        return False


def _u32(ids) -> bytes:
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


_encoders: dict[str, "Encoder"] = {}


class Encoder(dict):
    """Unit -> ids. When it is full it becomes the older generation, from
    which units in use come back."""

    def __init__(self, path: str):
        super().__init__()
        self.older: dict[str, bytes] = {}
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model

    @classmethod
    def at(cls, path: str) -> "Encoder":
        if path not in _encoders:
            _encoders[path] = cls(path)
        return _encoders[path]

    def _ids(self, text: str) -> bytes:
        return _u32(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def __missing__(self, unit: str) -> bytes:
        out = self.older.get(unit)
        if out is None:
            # what the tokenizer's own steps hand to its model for this unit
            signs = unit if unit.isascii() else "".join(map(_BYTE.__getitem__, unit.encode()))
            out = _u32(t.id for t in self.model.tokenize(signs))
        if len(unit) <= LONGEST_KEPT:
            self[unit] = out
        return out

    def encode(self, text: str | None) -> bytes:
        """Ids of the whole text, four bytes each."""
        if not text:
            return b""
        if not _plain(text):
            return self._ids(text)
        if len(self) > KEPT_UNITS:
            self.older = dict(self)
            self.clear()
        return b"".join(map(self.__getitem__, _UNIT.findall(text.lower())))
