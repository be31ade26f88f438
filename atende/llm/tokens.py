"""Byte-level BPE token ids inside tasks, with a bounded cache of space-separated pieces."""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
import tiktoken

# Pieces remembered by a Python worker before it starts anew. A cache only: it changes no result.
CACHE_PIECES = 400_000
# Fixed value: the pre-token pattern of the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Fixed value: white space of that pattern.
_SPACES = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# The pattern's search fails on white space much longer than this, so such runs are cut out before it.
LONG_RUN = 50_000
_LONG_SPACE = re.compile(f"[{_SPACES}]{{{LONG_RUN},}}")


def _byte_of_symbol() -> dict[str, int]:
    """The byte that each printable stand-in of a byte-level vocabulary means."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(4)
def encoding(path: str, pattern: str = PATTERN) -> tiktoken.Encoding:
    """The encoder of a byte-level BPE file of the tokenizers library; special strings are plain text."""
    with open(path, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    byte = _byte_of_symbol()
    ranks = {bytes(byte[c] for c in token): i for token, i in vocabulary.items() if all(c in byte for c in token) and token != "<|endoftext|>"}
    return tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


class _Pieces(dict):
    """Encoded form of ' ' + piece."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, piece: str):
        if len(self) >= CACHE_PIECES:
            self.clear()
        out = self[piece] = self.make(" " + piece)
        return out


class Encoder:
    """Ids of whole texts as packed little-endian unsigned 32-bit numbers.

    A space before a non-space starts a pre-token, so a text without double spaces is encoded piece by
    piece between its spaces; other texts are encoded as they are.
    """

    def __init__(self, path: str):
        self.path, self.enc = path, encoding(path)
        self.pieces = _Pieces(self.packed)

    def packed(self, text: str) -> bytes:
        if len(text) < LONG_RUN or not _LONG_SPACE.search(text):
            return self.enc.encode_to_numpy(text).astype("<u4").tobytes()
        parts, at, whole = [], 0, encoding(self.path, "(?s).+")  # takes a run as one pre-token
        for m in _LONG_SPACE.finditer(text):
            # A run before other text ends one character early: its last one starts the next pre-token.
            end = m.end() if m.end() == len(text) else m.end() - 1
            parts += [self.enc.encode_to_numpy(text[at: m.start()]), whole.encode_to_numpy(text[m.start(): end])]
            at = end
        return np.concatenate([*parts, self.enc.encode_to_numpy(text[at:])]).astype("<u4").tobytes()

    def __call__(self, text: str) -> bytes:
        if "  " in text or len(text) < 16:
            return self.packed(text)
        first, *rest = text.split(" ")
        return b"".join([self.packed(first), *map(self.pieces.__getitem__, rest)])


@lru_cache(2)
def encoder(path: str) -> Encoder:
    return Encoder(path)
