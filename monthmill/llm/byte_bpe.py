"""Byte-level BPE ids of whole texts, with a bounded memory of words."""

from __future__ import annotations

import json
import re
import sys
from array import array
from functools import lru_cache

import tiktoken

#: Words a worker remembers before it starts afresh; bounds its memory, not its results.
REMEMBERED = 300_000

# Fixed value: how this family of vocabularies cuts a text into words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _packed(ids: list[int]) -> bytes:
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


def _bytes_of(token: str, decoder: dict[str, int]) -> bytes:
    return bytes(decoder[c] for c in token)


def _byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in a vocabulary file: itself, or the next free code point from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


class ByteBPE:
    """Token ids of a text as little-endian unsigned 32-bit integers.

    A space before a non-space always begins a word, so texts without runs of white space are cut at spaces, which
    costs one dictionary look-up a word. All other texts go through the tokenizer whole. With `added`, the file's added
    tokens are found in a text first, as the library does, and what stands between them is encoded by itself; without,
    strings that look like them are ordinary text.
    """

    def __init__(self, path: str, added: bool = False) -> None:
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model, tokens = content["model"], content["added_tokens"] if added else []
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in tokens):
            raise ValueError("an added token with conditions on what stands beside it")
        self.added = {t["content"]: _packed([t["id"]]) for t in tokens}
        # At one place the longest is found.
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")").split
        alphabet = _byte_alphabet()
        special = {t for t in model["vocab"] if t.startswith("<|") and t.endswith("|>")}
        ranks = {_bytes_of(token, alphabet): rank for token, rank in model["vocab"].items() if token not in special}
        self.encoding = tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.words = _Words(self.encoding)
        self.runs = re.compile(r"\s\s|^\s").search

    def encode(self, text: str) -> bytes:
        if any(token in text for token in self.added):
            return b"".join(self.added[part] if n % 2 else self._between(part) for n, part in enumerate(self.cut(text)))
        return self._between(text)

    def _between(self, text: str) -> bytes:
        """Ids of a text, or of a part of it, in which no added token counts."""
        if not text:
            return b""
        if self.runs(text):
            return _packed(self.encoding.encode_ordinary(text))
        if len(self.words) > REMEMBERED:
            self.words.clear()
        first, *words = text.split(" ")
        return _packed(self.encoding.encode_ordinary(first)) + b"".join(map(self.words.__getitem__, words))


class _Words(dict):
    """Ids of a word with the space before it."""

    def __init__(self, encoding: tiktoken.Encoding) -> None:
        super().__init__()
        self.encode = encoding.encode_ordinary

    def __missing__(self, word: str) -> bytes:
        self[word] = ids = _packed(self.encode(" " + word))
        return ids


@lru_cache(maxsize=2)
def load(path: str, added: bool = False) -> ByteBPE:
    """One per worker, file and treatment of added tokens."""
    return ByteBPE(path, added)
