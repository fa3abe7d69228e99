"""Splitting text into pre-tokens, shared by the two byte-level BPE operators."""

from __future__ import annotations

import re

import public_tokenizers
import regex

PATTERN = public_tokenizers.PATTERN

_EXACT = regex.compile(PATTERN)
# On these characters the standard library's classes agree with the Unicode ones of the
# pattern (no marks, no numbers beyond 0-9, no control characters that count as space).
_PLAIN_TEXT = re.compile(r"[\t-\r -~À-ɏ]*")
_PLAIN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")


def pretokens(text: str) -> list[str]:
    """All matches of PATTERN.  Plain texts take a faster expression with equal matches."""
    return (_PLAIN if _PLAIN_TEXT.fullmatch(text) else _EXACT).findall(text)


class Generations(dict):
    """A memo of bounded size: when the young generation is full it becomes the old one.

    Subclasses give ``compute(key)``.
    """

    def __init__(self, size: int = 250_000):
        super().__init__()
        self.size, self.old = size, {}

    def compute(self, key):
        raise NotImplementedError

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value
