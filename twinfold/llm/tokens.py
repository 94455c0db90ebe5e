"""Token ids by a public byte-level BPE vocabulary of the tokenizers library, memoised by pre-token."""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable
from functools import lru_cache

#: How this public vocabulary splits text into pre-tokens (the library's own pattern, and that pattern
#: for texts of the characters below only, where both split alike).
PLAIN_CHARS = "\t\n\r\x20-\x7e¡-ɏ‐-‧"
PLAIN_SPLIT = r" ?[A-Za-zªµºÀ-ÖØ-öø-ɏ]+| ?[0-9²³¹¼-¾]+|'(?:[stmd]|re|ve|ll)| ?[^\sA-Za-z0-9ª²³µ¹º¼-¾À-ÖØ-öø-ɏ]+|\s+(?!\S)|\s+"

#: Pre-tokens that a worker remembers in each of two generations (about 200 bytes each).
MEMO = 300_000


def default_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pretokens() -> Callable[[str], list[str]]:
    """A function from a text to its pre-tokens."""
    import public_tokenizers
    import regex

    other, plain, full = re.compile(f"[^{PLAIN_CHARS}]"), re.compile(PLAIN_SPLIT), regex.compile(public_tokenizers.PATTERN)
    return lambda text: (full if other.search(text) else plain).findall(text)


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it prints, else one from 256 on."""
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Memo(dict):
    """A function's values by argument, in two generations: when the young one is full, the old one goes."""

    def __init__(self, function: Callable[[str], object], most: int | None = None):
        self.function, self.most, self.old = function, most or MEMO, {}

    def __missing__(self, key: str) -> object:
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        value = self[key] = self.old[key] if key in self.old else self.function(key)
        return value


class Encoder:
    """encode(text): the ids as little-endian unsigned 32-bit integers, equal to the library's for the whole text.

    A pre-token's ids do not depend on what stands around it, so they are looked up once for each distinct pre-token.
    Texts that hold a special token's string or characters outside PLAIN_CHARS go to the library whole.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.odd = re.compile(f"[^{PLAIN_CHARS}]").search
        self.split = re.compile(PLAIN_SPLIT).findall
        tokenize, letters = self.tokenizer.model.tokenize, byte_letters()
        self.memo = Memo(lambda part: array("I", [t.id for t in tokenize(part.encode().decode("latin-1").translate(letters))]).tobytes())

    def encode(self, text: str) -> bytes:
        if self.odd(text) or any(t in text for t in self.added):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        return b"".join(map(self.memo.__getitem__, self.split(text)))


@lru_cache(1)
def encoder(path: str) -> Encoder:
    """One for each process, so that what a worker remembers serves its next partition."""
    return Encoder(path)
