"""Subword ids of whole texts, for other than Latin letters with a bounded cache of
space-separated chunks.

A text of Latin letters is encoded whole by the faster library, which takes less time than
to look its chunks up. In the others, whose library is slow, the
byte-level vocabulary's pattern never joins two characters across a single
space between non-space characters, so the ids of a text are those of its chunks
(each with the space before it). Chunks repeat a lot; a cache per worker keeps
their ids and is emptied when it holds ``CACHE`` chunks. A text with white
space next to a space, or one that holds one of the vocabulary's added tokens (such as
``<|endoftext|>``), is encoded whole by the plain tokenizer.
"""

from __future__ import annotations

import base64
import re
from array import array

CACHE = 300_000
#: Code points beyond the Latin letters.
BEYOND = re.compile("[\u0250-\U0010ffff]")


def latin(text: str) -> bool:
    return text.isascii() or not BEYOND.search(text)


class _Odd(Exception):
    """A chunk begins or ends with white space: the text must be encoded whole."""


class _Chunks(dict):
    def __init__(self, encode, lead: str):
        self.encode, self.lead = encode, lead

    def __missing__(self, chunk: str) -> bytes:
        if not chunk or chunk[0].isspace() or chunk[-1].isspace():
            raise _Odd
        if len(self) >= CACHE:
            self.clear()
        ids = self[chunk] = self.encode(self.lead + chunk)
        return ids


class Subwords:
    """Ids as 32-bit bytes in the machine's order (little-endian). ``json`` and ``ranks`` are the two files
    of one byte-level vocabulary: texts of Latin letters go through the faster
    library, which gives the same ids; all others through ``tokenizers``."""

    def __init__(self, json: str, ranks: str, pattern: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_file(json)
        self.added = sorted(t.content for t in self.full.get_added_tokens_decoder().values())
        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.after, self.first = _Chunks(self.piece, " "), _Chunks(self.piece, "")

    def piece(self, text: str) -> bytes:
        """Ids of a text without added tokens."""
        if latin(text):
            return array("I", self.fast.encode_ordinary(text)).tobytes()
        return array("I", self.full.encode(text, add_special_tokens=False).ids).tobytes()

    def whole(self, text: str) -> bytes:
        if self.holds_added(text):
            return array("I", self.full.encode(text, add_special_tokens=False).ids).tobytes()
        return self.piece(text) if text else b""

    def holds_added(self, text: str) -> bool:
        return any(t in text for t in self.added)

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if self.holds_added(text):
            return self.whole(text)
        if latin(text):
            return self.piece(text)
        chunks = text.split(" ")
        try:
            return self.first[chunks[0]] + b"".join(map(self.after.__getitem__, chunks[1:]))
        except _Odd:
            return self.whole(text)


_MADE: dict[str, Subwords] = {}


def byte_bpe(name: str = "byte_bpe_50k") -> Subwords:
    """The worker's own encoder of a public byte-level vocabulary."""
    if name not in _MADE:
        import public_tokenizers as P

        _MADE[name] = Subwords(P.path(f"{name}.json"), P.path(f"{name}.tiktoken"), P.PATTERN)
    return _MADE[name]
