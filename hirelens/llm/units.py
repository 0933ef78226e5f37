"""Byte-level BPE by distinct pieces of text.

The pre-tokenizer's pattern always starts a new pre-token at a space between
two characters that aren't white space, and never looks across it. So a text
is cut there into units; each distinct unit, and in it each distinct
pre-token, is encoded once by the tokenizers library's model, and ids join.
"""

from __future__ import annotations

import functools
import json
import os
import re
from array import array
from collections.abc import Callable

import numpy as np

CACHED = 600_000        # distinct units kept by a worker process
MARKED = 1_000_000      # of these, small ones (see marked_split)
CACHED_CHARS = 64       # longer units aren't kept
_ODD = re.compile(r"[^\S \n]")
_CUT = re.compile(r"(?<=\S) (?=\S)")
# The byte-level pre-tokenizer's public pattern, written for texts whose
# characters lie below U+0250 and whose white space is spaces and newlines:
# there, the numbers are the decimal digits and these six signs.
BARE = "\x02"
_CUT_BEFORE = ".,;:!?"
_SIGNS_IN_A_ROW = re.compile(rf"(?:[^\w\s]|_)[{_CUT_BEFORE}]|{BARE}")
_SIGNS = "\u00b2\u00b3\u00b9\u00bc-\u00be"
_PRE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d"
                  rf"| ?[^\W\d_{_SIGNS}]+| ?[\d{_SIGNS}]+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")


class Cache(dict):
    """Values of units, computed when first asked for. A worker process keeps
    one for all its tasks. When half of ``limit`` is new, it becomes the old
    half and the older one goes, so frequent units stay and memory is bounded
    whatever the vocabulary."""

    def __init__(self, make: Callable[[str], object], limit: int = CACHED):
        super().__init__()
        self.make, self.half, self.old = make, limit // 2, {}

    def __missing__(self, unit: str):
        value = self.old.get(unit) or self.make(unit)
        if len(unit) <= CACHED_CHARS:
            if len(self) >= self.half:
                self.old = dict(self)
                self.clear()
            self[unit] = value
        return value

    def keep(self, unit: str, value: object) -> None:
        if len(unit) <= CACHED_CHARS:
            if len(self) >= self.half:
                self.old = dict(self)
                self.clear()
            self[unit] = value


def split(text: str) -> list[str]:
    """The units; all but the first have lost the space before them."""
    units = text.split(" ")
    if "" in units or "\n " in text or " \n" in text or _ODD.search(text):
        return _CUT.split(text)  # a space beside white space is no cut
    return units


def marked_split(text: str) -> list[str] | None:
    """Smaller units: cut before a full stop, comma and the like too, and
    around a newline; units that had no space before them begin with ``BARE``.
    So a word is one unit, whatever follows it. None where such a cut could
    part a pre-token: a mark after another sign, or white space in a row."""
    if _SIGNS_IN_A_ROW.search(text) or "\n\n" in text or "\n " in text or " \n" in text or _ODD.search(text):
        return None
    for mark in _CUT_BEFORE:
        text = text.replace(mark, f" {BARE}{mark}")
    units = text.replace("\n", f" {BARE}\n {BARE}").split(" ")
    return None if "" in units[1:] else units


def _byte_letters() -> dict[int, int]:
    """The letters that stand for bytes in a byte-level vocabulary: visible
    Latin-1 characters for themselves, the others from code point 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = sorted(set(range(256)) - set(plain))
    return {b: b for b in plain} | {b: 256 + i for i, b in enumerate(rest)}


class Encoder:
    """``ids(text)``: the library's ids of a whole text, as bytes of ``kind``
    (16 bits if the vocabulary fits). Special tokens named in a text are
    encoded as the library's default does."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        told = json.loads(self.tokenizer.to_str())
        before = told.get("pre_tokenizer") or {}
        self.by_unit = (before.get("type") == "ByteLevel" and before.get("use_regex", True)
                        and not before.get("add_prefix_space") and not told.get("normalizer")
                        and all(t["special"] and " " not in t["content"] for t in told["added_tokens"]))
        self.library_only = re.compile("|".join(
            [r"[^\S \n]", "[\u0250-\U0010ffff]", *(re.escape(t["content"]) for t in told["added_tokens"])]))
        self.letters = _byte_letters()
        self.code = "H" if self.kind.itemsize == 2 else "I"
        self.pre = Cache(self._model_ids)
        self.first, self.rest = Cache(self.unit_ids), Cache(lambda u: self.unit_ids(" " + u))
        self.marked, self.space = Cache(self._marked_ids, MARKED), chr(self.letters[0x20])

    def _library_ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.kind).tobytes()

    def _model_ids(self, pre: str) -> bytes:
        return self._mapped_ids(pre.encode().decode("latin-1").translate(self.letters))

    def _mapped_ids(self, mapped: str) -> bytes:
        return array(self.code, [t.id for t in self.model.tokenize(mapped)]).tobytes()

    def _marked_ids(self, unit: str) -> bytes:
        """Ids of a unit of :func:`marked_split`. Letters of the Latin blocks
        need no pattern, and no second place in a cache."""
        if unit.isalpha() and unit.isascii():
            return self._mapped_ids(self.space + unit)
        if unit.isalpha() and max(unit) < "\u0250":
            return self._model_ids(" " + unit)
        return self.unit_ids(unit[1:] if unit.startswith(BARE) else " " + unit)

    def pre_tokens(self, unit: str) -> list[str] | None:
        """The pre-tokens of a unit; None if only the library should cut it
        (special tokens, rare white space, letters beyond the Latin blocks)."""
        return None if self.library_only.search(unit) else _PRE.findall(unit)

    def unit_ids(self, unit: str) -> bytes:
        cut = self.pre_tokens(unit)
        return self._library_ids(unit) if cut is None else b"".join(map(self.pre.__getitem__, cut))

    def ids(self, text: str) -> bytes:
        if not text:
            return b""
        if not self.by_unit:
            return self._library_ids(text)
        units, known = marked_split(text), self.marked
        if units is None:
            units, known = split(text), self.rest
        head, *rest = units
        return self.first[head] + b"".join(map(known.__getitem__, rest))


@functools.cache
def encoder(path: str) -> Encoder:
    """The worker process's encoder for a tokenizer file."""
    return Encoder(path)


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)
