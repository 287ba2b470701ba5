"""Token ids of whole texts by a public tokenizer, one library call per new word instead of per text.

Texts are cut only where the tokenizer itself always ends a piece, so the ids of the parts joined are the
ids of the text (held against the library in tests). Most words come again; their ids are remembered per
Python worker, within a bound, which is several times faster than encoding every text anew.
"""

from __future__ import annotations

import codecs
import os
import re
import string
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MAX_REMEMBERED = 1_200_000  # words per worker, some 150 bytes each; past half of it the older half is forgotten
MAX_WORD = 48  # longer parts are encoded but not remembered
TOGETHER = 8_000_000  # characters of texts whose different words are looked up at once

_UNEQUAL = "\x1c\x1d\x1e\x1f"  # white space for Python but not for the tokenizers: such texts stay whole
_BYTE_LEVEL = re.compile(r" ?\S+|\s+(?=\s\S)|\s+")
# Blanks and line feeds between words are handled directly; these and runs of blanks are left to the pattern above.
_OTHER_BLANKS = [c for c in map(chr, range(0x10000)) if c.isspace() and c not in " \n"] + ["  ", "\n\n", " \n", "\n "]
_OTHER_ASCII_BLANKS = [c for c in _OTHER_BLANKS if c.isascii()]
# Latin letters, which composition leaves alone (the dotted capital I, which lower-cases to two, is left out).
_LATIN = re.compile("[A-Za-zÀ-ÖØ-öø-įı-ƺ]+")
_MARKS = string.punctuation.replace("'", "")  # a run of these after a letter is one piece, if nothing follows it
# The pieces of an ASCII part without blanks, as both pre-tokenizers cut it ("words" also cuts numbers into digits).
_PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[A-Za-z]+|[0-9]+|[^A-Za-z0-9]+")


def _byte_letters() -> str:
    """The letter that stands for each byte in byte-level vocabularies: itself if printable, else from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    letters = {b: chr(b) for b in printable} | {b: chr(0x100 + i) for i, b in enumerate(others)}
    return "".join(letters[b] for b in range(256))


class _Words(dict):
    """Ids by part of a text; a part that is missing is made of its pieces or encoded by the library, and remembered.

    ``before``: the text before each part that belongs to it but is not in the key. ``inner``: the ids of pieces
    that follow another within a part, with nothing before them.
    """

    def __init__(self, tokenizer, lower: bool, before: str = "", inner: _Words | None = None):
        self._tokenizer, self._model, self._lower, self._before = tokenizer, tokenizer.model, lower, before
        self._inner = self if inner is None else inner
        self._older: dict[str, bytes] = {}
        self._letters = _byte_letters()
        self._first = self._in_letters(before)

    def forget_older(self) -> None:
        """What was met since the last call is kept once more; what was not is forgotten."""
        self._older = self.copy()
        self.clear()

    def _in_letters(self, text: str) -> str:
        return codecs.charmap_decode(text.encode(), "strict", self._letters)[0]

    def _library(self, part: str) -> bytes:
        return array("I", self._tokenizer.encode(part, add_special_tokens=False).ids).tobytes()

    def _known(self, part: str) -> bytes | None:
        ids = self.get(part)
        return self._older.get(part) if ids is None else ids

    def _encoded(self, part: str) -> bytes:
        word = part.rstrip(_MARKS)
        ascii = word.isascii() and word.isalpha()
        if ascii or _LATIN.fullmatch(word):
            ids = None if word is part else self._known(word)
            if ids is None:
                small = word.lower() if self._lower else word
                ids = None if small is word else self._known(small)
            if ids is None:
                piece = self._first + (small if ascii else self._in_letters(small))
                ids = array("I", [t.id for t in self._model.tokenize(piece)]).tobytes()
            return ids if word is part else ids + self._inner[part[len(word):]]
        # An apostrophe or a blank at the start goes with the text before or after it.
        if part.isascii() and part[:1] != "'" and not part[:1].isspace():
            first, *others = _PIECES.findall(part.lower() if self._lower else part) or [part]
            if others:
                return b"".join([self[first], *map(self._inner.__getitem__, others)])
        return self._library(self._before + part)

    def __missing__(self, part: str) -> bytes:
        ids = self._older.get(part)
        if ids is None:
            ids = self._encoded(part)
        if len(part) <= MAX_WORD:
            self[part] = ids
        return ids


class Encoder:
    """Ids as little-endian unsigned 32-bit integers.

    ``split``: how texts may be cut. "words" where the normalizer lower-cases and turns white space into one
    blank and the pre-tokenizer drops it; "byte_level" where a word takes the one blank before it along; None
    for any other tokenizer: texts are encoded whole.
    """

    def __init__(self, path: str, split: str | None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # one core per task
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        # A text that holds the string of an added token stays whole: the library finds it before it cuts.
        added = self._tokenizer.get_added_tokens_decoder().values()
        self._whole = [*_UNEQUAL, *(t.content for t in added)]
        self._split = None if any(t.normalized for t in added) else split  # found only after normalizing
        self._words = _Words(self._tokenizer, lower=split == "words")
        self._later = _Words(self._tokenizer, lower=False, before=" ", inner=self._words)

    def whole(self, text: str) -> bytes:
        return array("I", self._tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _forget(self) -> None:
        if 2 * (len(self._words) + len(self._later)) > MAX_REMEMBERED:
            self._words.forget_older()
            self._later.forget_older()

    def encode(self, text: str) -> bytes:
        """Ids of a text, with no special ids added."""
        if self._split is None or any(c in text for c in self._whole):
            return self.whole(text)
        self._forget()
        first, later = self._words.__getitem__, self._later.__getitem__
        if self._split == "words":
            return b"".join(map(first, text.split()))
        if self._odd_blanks(text):
            return b"".join(map(first, _BYTE_LEVEL.findall(text)))
        ids = []
        for line in text.split("\n"):
            word, *words = line.split(" ")
            ids.append(first(word))
            ids += map(later, words)
            ids.append(first("\n"))
        return b"".join(ids[:-1])

    def encode_all(self, texts: Iterable[str]) -> Iterator[bytes]:
        """Ids of each text, as ``encode`` gives them; a word that comes often in neighbouring texts is looked up once."""
        some, size = [], 0
        for text in texts:
            some.append(text)
            size += len(text)
            if size >= TOGETHER:
                yield from self._together(some)
                some, size = [], 0
        yield from self._together(some)

    def _odd_blanks(self, text: str) -> bool:
        """Whether a text has other blanks than single ones and single line feeds between words."""
        return text != text.strip() or any(c in text for c in (_OTHER_ASCII_BLANKS if text.isascii() else _OTHER_BLANKS))

    def _lines(self, part: str, words: _Words) -> bytes:
        """Ids of a part between two blanks; every word but its first follows a line feed."""
        if "\n" not in part:
            return words[part]
        first, *others = part.split("\n")
        return b"".join([words[first], *(self._words["\n"] + self._words[o] for o in others)])

    def _together(self, texts: list[str]) -> Iterator[bytes]:
        # A text that is longer than all texts taken together should be is encoded line by line.
        plain = [
            self._split == "byte_level" and len(t) <= TOGETHER and not any(c in t for c in self._whole)
            and not self._odd_blanks(t) for t in texts]
        found = self._by_different_parts([t for t, p in zip(texts, plain) if p])
        for text, p in zip(texts, plain):
            yield next(found) if p else self.encode(text)

    def _by_different_parts(self, texts: list[str]) -> Iterator[bytes]:
        if not texts:
            return
        self._forget()
        lists = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        starts, parts = lists.offsets.to_numpy(), lists.flatten().dictionary_encode()
        different = pa.ListArray.from_arrays([0, len(parts.dictionary)], parts.dictionary)
        # One string is decoded much faster than a list of them.
        different = pc.binary_join(different, pa.scalar(" ", pa.large_string()))[0].as_py().split(" ")
        ids = [self._lines(part, self._later) for part in different]
        places = parts.indices.to_numpy().astype(np.int64)
        places[starts[:-1]] = np.arange(len(texts)) + len(ids)  # no blank before the first part of a text
        ids += [self._lines(text.split(" ", 1)[0], self._words) for text in texts]
        joined = pa.array(ids, pa.large_binary()).take(pa.array(places))
        _, ends, data = joined.buffers()
        bounds, data = np.frombuffer(ends, np.int64)[starts].tolist(), memoryview(data)
        for a, b in zip(bounds, bounds[1:]):
            yield bytes(data[a:b])


_ENCODERS: dict[tuple[str, str | None], Encoder] = {}


def encoder(path: str, split: str | None) -> Encoder:
    """The worker's encoder for a vocabulary file."""
    if (path, split) not in _ENCODERS:
        _ENCODERS[path, split] = Encoder(path, split)
    return _ENCODERS[path, split]
