"""Whole texts to token ids by a tokenizer file, with a table of known chunks.

Byte-pair tokenizers split a text into pre-tokens and merge inside each of them, so the ids
of a text are the ids of its parts wherever a part ends at a certain pre-token boundary.
Encoding a part once for all its occurrences is many times faster than encoding texts.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterable

import numpy as np

# White space that the tokenizers' patterns and Python's ``\s`` do not both know.
DISPUTED = re.compile(r"[\x1c-\x1f]")
# Letters that stand for themselves in every normal form.
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
SYMBOLS = r"""!"#$%&()*+,\-./:;<=>?@\[\\\]^_`{|}~"""


def byte_letters() -> dict[int, str]:
    """How byte-level tokenizers write the letters above ASCII: a character for each byte.

    Printable bytes stand for themselves; the others follow from 256 on.
    """
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in printable]
    shown = {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(rest)}
    letters = {c: "".join(shown[b] for b in chr(c).encode()) for c in range(0xC0, 0x100)}
    return letters | {ord(" "): shown[ord(" ")]}


class Known(dict):
    """Results of ``find`` by key; at most ``limit`` are kept, which affects speed only."""

    def __init__(self, find: Callable[[str], bytes], limit: int) -> None:
        super().__init__()
        self.find, self.limit = find, limit

    def __missing__(self, key: str) -> bytes:
        value = self.find(key)
        if len(self) < self.limit:
            self[key] = value
        return value


class ChunkEncoder:
    """Ids of texts as little-endian unsigned 32-bit bytes.

    ``spaces="kept"`` is for byte-level vocabularies where white space belongs to the
    following word; ``spaces="dropped"`` for those that lower the case and discard white
    space. Chunks of one word and symbols go straight to the tokenizer's model, others
    through the whole tokenizer, and a text with unusual white space goes there unsplit.
    """

    def __init__(self, path: str, spaces: str, limit: int = 400_000) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        if spaces not in ("kept", "dropped"):
            raise ValueError(f"spaces is kept or dropped, not {spaces}")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.model._resize_cache(0)
        self.letters = byte_letters()
        self.simple = re.compile(f"([ \n]?)([{LETTERS}]+)([{SYMBOLS}]*)").fullmatch
        self.words = Known(self._word, limit)
        self.chunks = Known(self._dropped if spaces == "dropped" else self._kept, limit)
        self.parts = str.split if spaces == "dropped" else self._spaced
        self.newline = self._whole("\n")

    def _whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def _word(self, word: str) -> bytes:
        tokens = self.tokenizer.model.tokenize(word.translate(self.letters))
        return np.array([t.id for t in tokens], "<u4").tobytes()

    def _dropped(self, chunk: str) -> bytes:
        if not (match := self.simple(chunk)):
            return self._whole(chunk)
        _, word, symbols = match.groups()
        ids = self.words[word.lower()]
        return ids + self.words[symbols] if symbols else ids

    def _kept(self, chunk: str) -> bytes:
        """Ids of a chunk of :meth:`_spaced`, which leaves out the space before it."""
        chunk = chunk if chunk[:1] == "\n" else " " + chunk
        if not (match := self.simple(chunk)):
            return self._whole(chunk)
        lead, word, symbols = match.groups()
        ids = self.newline + self.words[word] if lead == "\n" else self.words[lead + word]
        return ids + self.words[symbols] if symbols else ids

    @staticmethod
    def _spaced(text: str) -> list[str]:
        return text.replace("\n", " \n").split(" ")

    def _one(self, text: str | None) -> bytes:
        if not text:
            return b""
        if DISPUTED.search(text):
            return self._whole(text)
        if self.parts is str.split:
            return b"".join(map(self.chunks.__getitem__, text.split()))
        # Single spaces and line ends between other characters end pre-tokens.
        if len(text.split()) != text.count(" ") + text.count("\n") + 1:
            return self._whole(text)
        first, *rest = self._spaced(text)
        return self._whole(first) + b"".join(map(self.chunks.__getitem__, rest))

    def __call__(self, texts: Iterable[str | None]) -> list[bytes]:
        return [self._one(t) for t in texts]


_ENCODERS: dict[tuple[str, str], ChunkEncoder] = {}


def encoder(path: str, spaces: str) -> ChunkEncoder:
    """The encoder of this Python worker, which later tasks use again."""
    key = (path, spaces)
    if key not in _ENCODERS:
        _ENCODERS[key] = ChunkEncoder(path, spaces)
    return _ENCODERS[key]
