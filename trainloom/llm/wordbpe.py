"""Word-level memo around the tokenizers library for vocabularies that drop white space."""

from __future__ import annotations

import struct
import unicodedata

import numpy as np
import regex

# White space to Python's str.split() but not to the vocabulary's own pattern.
_SEPARATORS = "\x1c\x1d\x1e\x1f"
# The split pattern that the vocabulary file itself declares.
_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
# Below this code point, text without combining marks is its own composed form.
_SIMPLE_BELOW = "ɐ"
# Marks that make a piece of their own behind a word (no contraction follows).
_MARKS = frozenset("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")


def _byte_letters() -> dict[int, str]:
    """Byte -> printable stand-in: printable Latin-1 as is, the others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


KEPT_CHARS = 64


class ChunkIds(dict):
    """white-space-delimited chunk -> its ids as little-endian uint32 bytes.

    The normaliser (composition, white space, lower case) and the split pattern
    never look across white space, so a text's ids are those of its chunks in
    order. Frequent chunks are encoded once per worker; both tables hold at most
    ``limit`` entries of ``KEPT_CHARS`` characters, which bounds their bytes; other
    chunks are encoded each time.
    """

    def __init__(self, path: str, limit: int = 200_000):
        from tokenizers import Tokenizer
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.limit = limit
        self.pieces: dict[str, bytes] = {}
        self.letters = _byte_letters()

    def __missing__(self, chunk: str) -> bytes:
        ids = self._chunk(chunk)
        if len(self) < self.limit and len(chunk) <= KEPT_CHARS:
            self[chunk] = ids
        return ids

    def _library(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _chunk(self, chunk: str) -> bytes:
        if not chunk.isascii():
            if max(chunk) >= _SIMPLE_BELOW:
                return self._library(chunk)
            chunk = unicodedata.normalize("NFC", chunk)
        if "<|" in chunk:
            return self._library(chunk)
        chunk = chunk.lower()
        # A word, or a word and one mark, needs no pattern.
        if chunk.isalpha():
            return self._piece(chunk)
        if chunk[-1] in _MARKS and (word := chunk[:-1]).isalpha():
            return self._piece(word) + self._piece(chunk[-1])
        return b"".join(map(self._piece, _PIECES.findall(chunk)))

    def _piece(self, piece: str) -> bytes:
        ids = self.pieces.get(piece)
        if ids is None:
            shown = piece if piece.isascii() and piece.isalpha() else piece.encode().decode("latin-1").translate(self.letters)
            tokens = [t.id for t in self.model.tokenize(shown)]
            ids = struct.pack(f"<{len(tokens)}I", *tokens)
            if len(self.pieces) < self.limit and len(piece) <= KEPT_CHARS:
                self.pieces[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if any(c in text for c in _SEPARATORS):
            return self._library(text)
        return b"".join(map(self.__getitem__, text.split()))


_LOADED: dict[str, ChunkIds] = {}


def load(path: str) -> ChunkIds:
    """One table per worker process and vocabulary."""
    if path not in _LOADED:
        _LOADED[path] = ChunkIds(path)
    return _LOADED[path]
