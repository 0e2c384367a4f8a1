"""Tokenising whole texts with the tokenizers library and a cache of word pieces.

Neither vocabulary lets a token span the border between a non-blank and a blank, so
a text's ids are the ids of its ``blanks + non-blanks`` pieces in order. Pieces repeat
a lot; each worker keeps the ids of the recent ones. A piece that is one word of Latin
letters, with a blank before it and marks behind it or not, goes to the library's
model at once: what its normaliser and splitter make of each letter, and of each run of
marks, is asked once.
"""

from __future__ import annotations

import os
import re
import string
from array import array
from collections.abc import Callable

#: Unicode White_Space: what ``isspace`` accepts but for the four separators U+001C to U+001F
BLANKS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace() and not 0x1C <= c <= 0x1F)
LETTERS = [c for c in map(chr, range(0x250)) if c.isalpha()]
PIECES = re.compile(f"[{BLANKS}]*[^{BLANKS}]+|[{BLANKS}]+")


class _Cache(dict):
    """Ids of pieces, each with ``lead`` before it, in two generations of at most ``keep``.

    When the younger is full it replaces the older; pieces still in use move up again.
    """

    def __init__(self, find: Callable[[str], list[int]], lead: str, keep: int):
        super().__init__()
        self.find, self.lead, self.keep, self.old = find, lead, keep, {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = array("I", self.find(self.lead + piece)).tobytes()
        if len(self) >= self.keep:
            self.old = dict(self)
            self.clear()
        if len(piece) <= 64:
            self[piece] = ids
        return ids


class PieceEncoder:
    """Ids of a text as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, keep: int = 700_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.pieces, self.spaced = _Cache(self._ids, "", keep), _Cache(self._ids, " ", keep)
        self._learn_words()

    def _split(self, piece: str) -> list[str]:
        t = self.tokenizer
        clean = t.normalizer.normalize_str(piece) if t.normalizer else piece
        return [part for part, _ in t.pre_tokenizer.pre_tokenize_str(clean)]

    def _learn_words(self) -> None:
        """Letters that are split off nowhere, each with its form for the model."""
        a = "".join(self._split("a"))
        self.lead = "".join(self._split(" a")).removesuffix(a)
        self.forms = {}
        for c in LETTERS:
            form = self._split(c)
            if (len(form) == 1 and self._split(f"a{c}a") == [a + form[0] + a] and self._split(f" {c}") == [self.lead + form[0]]):
                self.forms[ord(c)] = form[0]
        ascii_forms = {chr(c): form for c, form in self.forms.items() if c < 128}
        #: what becomes of words of ASCII letters, if it is as simple as that
        self.simple = next((f for f in (str, str.lower) if all(f(c) == form for c, form in ascii_forms.items())), None)
        self.a, self.tails = a, {"": []}
        self.word = re.compile(f"( ?)([{''.join(map(chr, self.forms))}]+)([{re.escape(string.punctuation)}]*)").fullmatch

    def _tail(self, tail: str) -> list[int] | None:
        """Ids of marks behind a word, which no splitter joins with letters before them; None if this one does."""
        parts = self._split("a" + tail)
        ids = [i for part in parts[1:] for i in self._model_ids(part)] if parts[:1] == [self.a] else None
        if len(self.tails) < 10_000:
            self.tails[tail] = ids
        return ids

    def _model_ids(self, part: str) -> list[int]:
        return [token.id for token in self.tokenize(part)]

    def encode(self, text: str) -> bytes:
        """Lines of words with one space between them are split at once, other texts with a pattern."""
        parts: list[bytes] = []
        piece, spaced = self.pieces.__getitem__, self.spaced.__getitem__
        for k, line in enumerate(text.split("\n")):
            words = line.split()
            gaps = len(words) - 1
            if line.count(" ") != gaps or sum(map(len, words)) + gaps != len(line):
                return b"".join(map(piece, PIECES.findall(text)))
            parts.append(piece("\n" + words[0] if k else words[0]))
            parts.extend(map(spaced, words[1:]))
        return b"".join(parts)

    def _ids(self, piece: str) -> list[int]:
        if found := self.word(piece):
            blank, word, marks = found.groups()
            tail = self.tails[marks] if marks in self.tails else self._tail(marks)
            if tail is not None:
                word = self.simple(word) if self.simple and word.isascii() else word.translate(self.forms)
                return [token.id for token in self.tokenize(self.lead + word if blank else word)] + tail
        if any(s in piece for s in self.special):
            return self.tokenizer.encode(piece, add_special_tokens=False).ids
        return [i for part in self._split(piece) for i in self._model_ids(part)]


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """The worker's encoder for a vocabulary file; its cache outlives a task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]
