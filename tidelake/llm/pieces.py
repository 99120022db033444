"""Pre-tokens and the bounded cache of what was worked out for them."""

from __future__ import annotations

import re
from collections.abc import Callable

import public_tokenizers
import regex

PATTERN = public_tokenizers.PATTERN

# A worker remembers so many short pre-tokens of late, and those of the time before: some
# 200 MB at most.
CACHE_PIECES = 400_000
CACHE_CHARS = 64


class Cache(dict):
    """``cache[piece]`` is ``work(piece)``, remembered within fixed bounds.

    When it is full, a new one begins, which takes over what is asked for again.
    """

    def __init__(self, work: Callable[[str], object], pieces: int = CACHE_PIECES):
        super().__init__()
        self._work, self._pieces, self._before = work, pieces, {}

    def __missing__(self, piece: str):
        value = self._before.get(piece)
        if value is None:
            value = self._work(piece)
        if len(piece) <= CACHE_CHARS:
            if len(self) >= self._pieces:
                self._before = dict(self)
                self.clear()
            self[piece] = value
        return value


# The classes of PATTERN written out for code points up to LATIN, where a plain
# expression finds the same pre-tokens in less time.
LATIN = "\u024f"
LETTERS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f"
NUMBERS = "0-9\xb2\xb3\xb9\xbc-\xbe"
SPACES = " \t-\r\x85\xa0"
_LATIN_PATTERN = (
    f" ?[{LETTERS}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[{NUMBERS}]+| ?[^{SPACES}{LETTERS}{NUMBERS}]+"
    f"|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+"
)
_beyond_latin = re.compile(f"[^\0-{LATIN}]").search


def is_latin(text: str) -> bool:
    return text.isascii() or _beyond_latin(text) is None


def splitter(pattern: str = PATTERN) -> Callable[[str], list[str]]:
    """Cuts a text into pre-tokens; together they are the whole text."""
    general = regex.compile(pattern).findall
    if pattern != PATTERN:
        return general
    latin = re.compile(_LATIN_PATTERN).findall
    return lambda text: latin(text) if is_latin(text) else general(text)
