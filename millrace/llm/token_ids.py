"""Token ids of texts by a tokenizer file, with the ids of words kept."""

from __future__ import annotations

import json
import os
import string
import sys
from array import array

# Words, and pieces of words, kept with their ids in each of two generations.
KEPT = 300_000
# Marks: behind a letter or digit a run of them at a word's end is encoded apart.
_TAIL = string.punctuation


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    """Path of a public tokenizer."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


class _Apart(Exception):
    """A word cannot be encoded apart from its neighbours."""


def _byte_signs() -> str:
    """The sign that byte-level models have for each byte: itself where it prints, else the next one from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = {b: 0x100 + n for n, b in enumerate(sorted(set(range(256)) - set(shown)))}
    return "".join(chr(hidden.get(b, b)) for b in range(256))


_SIGNS = _byte_signs()
_SPACE = _SIGNS[0x20]


class _Kept(dict):
    """Values made when first asked for. When it is full it becomes the old generation, and what is asked for again is taken over."""

    def __init__(self, make):
        super().__init__()
        self.make, self.old = make, {}

    def __missing__(self, key: str) -> bytes:
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= KEPT:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class TokenIds:
    """Ids of whole texts as little-endian 32-bit integers, without special tokens added.

    The tokenizer's word pattern always cuts before a space that stands between
    two other characters, around a line end between two of them, and between a
    letter or digit and the marks at a word's end. What stands between such
    places is encoded apart, a word with the space before it, and kept. Texts
    where another white space character stands at such a place, or that hold the
    string of a special token, are encoded whole. Both give what the tokenizer
    gives for the text; an empty text has no ids. Single words of Latin letters
    are one unit of the pattern and go to the tokenizer's model at once. A
    tokenizer that cuts by another pattern encodes all texts whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model = self.tokenizer.model
        parts = json.loads(self.tokenizer.to_str())
        how = parts["pre_tokenizer"] or {}
        self.cuts = how.get("type") == "ByteLevel" and how.get("use_regex") and not how.get("add_prefix_space") and not parts["normalizer"]
        self.marks = _Kept(self._whole)
        self.first, self.later = self._words(""), self._words(" ")

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _words(self, before: str) -> _Kept:
        """The ids of words that have ``before`` in front of them."""
        tokenize, whole, marks = self.model.tokenize, self._whole, self.marks
        ids = [n.to_bytes(4, sys.byteorder) for n in range(self.tokenizer.get_vocab_size())]
        lead = _SPACE if before else ""

        def make(word: str) -> bytes:
            # Only Latin letters are surely letters to the pattern as well.
            if word.isalpha():
                if word.isascii():
                    return b"".join([ids[t.id] for t in tokenize(lead + word)])
                if max(word) <= "\u024f":
                    return b"".join([ids[t.id] for t in tokenize((before + word).encode().decode("latin-1").translate(_SIGNS))])
                return whole(before + word)
            stem = word.rstrip(_TAIL)
            if stem.isalpha():
                return kept[stem] + marks[word[len(stem) :]]
            if not word or word[0].isspace() or word[-1].isspace():
                raise _Apart
            if stem and stem != word and stem[-1].isalnum():
                return kept[stem] + marks[word[len(stem) :]]
            return whole(before + word)

        kept = _Kept(make)
        return kept

    def _line(self, line: str) -> bytes:
        word, space, rest = line.partition(" ")
        if not space:
            return self.first[word]
        return self.first[word] + b"".join(map(self.later.__getitem__, rest.split(" ")))

    def __call__(self, text: str) -> bytes:
        if not text or not self.cuts or any(s in text for s in self.special):
            return self._whole(text)
        try:
            return self.marks["\n"].join(map(self._line, text.split("\n")))
        except _Apart:
            return self._whole(text)


_LOADED: dict[str, TokenIds] = {}


def token_ids(path: str) -> TokenIds:
    """The encoder of a tokenizer file, made once in a worker process."""
    if path not in _LOADED:
        _LOADED[path] = TokenIds(path)
    return _LOADED[path]
