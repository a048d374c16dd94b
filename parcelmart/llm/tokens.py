"""Token ids of whole texts, by the tokenizers library, with a bounded store of the ids of words.

Both vocabularies split a text before any merge, never inside a run without white space. So the ids of a text are the
ids of its words one after the other, and a word that was met before need not be encoded again. Texts that hold the string
of a special token are encoded as a whole.
"""

from __future__ import annotations

import codecs
import re
import sys
from array import array
from collections.abc import Callable

import numpy as np

from parcelmart.llm.common import KEPT

#: The kind of what a worker keeps: the stores of words.
WORDS = "words"
#: Bytes of words and ids in each of two generations, with what Python needs for an entry; words past ``LONG`` are not stored.
STORED_BYTES, ENTRY, LONG = 176 << 20, 150, 100
#: What is not a composed Latin letter, or whose lower case is a letter and a mark.
_other = re.compile("[^\0-\u024f]|\u0130").search


def _byte_characters() -> dict[str, str]:
    """The printable character that stands for each byte in a byte-level vocabulary: itself, or the next from 256 on."""
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in shown]
    return {chr(b): chr(b) for b in shown} | {chr(b): chr(256 + i) for i, b in enumerate(others)}


_BYTE_CHARACTERS = _byte_characters()
#: The same by byte, as a table for a decoder.
_SHOWN = "".join(_BYTE_CHARACTERS[chr(b)] for b in range(256))


def id_bytes(ids: list[int]) -> bytes:
    return np.asarray(ids, dtype="<u4").tobytes()


def _few_bytes(ids: list[int]) -> bytes:
    """The same, sooner for a few ids."""
    return array("I", ids).tobytes()


_word_bytes = _few_bytes if sys.byteorder == "little" and array("I").itemsize == 4 else id_bytes


class Words(dict):
    """Ids (little-endian, 32 bits each) of a word behind a blank or line break.

    When full it becomes the older generation; words met again come back from there, the others are forgotten.
    """

    def __init__(self, encode: Callable[[str], list[int]], lead: str, latin: Callable[[str, bool], bytes]):
        super().__init__()
        self.encode, self.lead, self.latin, self.older, self.size = encode, lead, latin, {}, 0
        self.ends = {mark: id_bytes(encode(mark)) for mark in ".,"}
        self.line_break = id_bytes(encode("\n"))

    def __missing__(self, word: str) -> bytes:
        if self.size >= STORED_BYTES:
            self.older = dict(self)
            self.clear()
            self.size = 0
        if (known := self.older.get(word)) is not None:
            self.size += ENTRY  # the strings are shared
            self[word] = known
            return known
        ids = self._ids(word)
        if len(word) <= LONG:
            self.size += ENTRY + len(word) + len(ids)
            self[word] = ids
        return ids

    def _ids(self, word: str) -> bytes:
        if word.isalpha():
            if word.isascii() or not _other(word):
                return self.latin(word, True)
        elif word[-1:] in self.ends and (word[-2:-1].isascii() or not _other(word[-2])):
            if word[-2:-1].isalpha():
                return self[word[:-1]] + self.ends[word[-1]]
        if word[:1] != "\n":
            return id_bytes(self.encode(self.lead + word))
        rest = word[1:]
        if rest.isalpha() and not _other(rest):
            return self.line_break + self.latin(rest, False)  # the break is a piece of its own
        return id_bytes(self.encode(word))


class Encoder:
    """``encoder(text)`` gives the ids as bytes. ``blank_matters``: words carry the blank before them (byte-level)."""

    def __init__(self, path: str, blank_matters: bool):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        merges = tokenizer.model
        self.special = [token.content for token in tokenizer.get_added_tokens_decoder().values()]
        self.encode = lambda text: tokenizer.encode(text, add_special_tokens=False).ids
        self.blank_matters = blank_matters
        lead = _BYTE_CHARACTERS[" "] if blank_matters else ""

        def latin(word: str, behind_blank: bool) -> bytes:
            """A word of composed Latin letters is not split or normalised beyond case: straight to the merges."""
            shown = word if blank_matters else word.lower()
            if not shown.isascii():
                shown = codecs.charmap_decode(shown.encode(), "strict", _SHOWN)[0]
            ids = [t.id for t in merges.tokenize(lead + shown if behind_blank else shown)]
            return _word_bytes(ids)

        self.words = Words(self.encode, " " if blank_matters else "", latin)

    def __call__(self, text: str | None) -> bytes:
        if not text:
            return b""
        if any(mark in text for mark in self.special):  # it has an id of its own, also inside a word: encode the text as a whole
            return id_bytes(self.encode(text))
        if not self.blank_matters:
            return b"".join(map(self.words.__getitem__, text.replace("\n", " ").split(" ")))
        marked = text.replace("\n", " \n")
        if "  " in marked or "\n " in marked or marked[0] == " " or marked[-1] in " \n":
            return id_bytes(self.encode(text))  # a run of white space is split in its own way: encode the text as a whole
        pieces = marked.split(" ")
        return id_bytes(self.encode(pieces[0])) + b"".join(map(self.words.__getitem__, pieces[1:]))


_ENCODERS: dict[str, Encoder] = KEPT.setdefault(WORDS, {})


def encoder(path: str, blank_matters: bool) -> Encoder:
    """One per worker process: its words serve all tasks that run there, until tasks of another kind do."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path, blank_matters)
    return _ENCODERS[path]
