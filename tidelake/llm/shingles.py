"""Sets of hashed word shingles, computed for many texts at once.

Words are runs of bytes other than ``[\\x20\\x09-\\x0D]``, with A-Z lower-cased. A set
holds the distinct hashes of all five-word windows, or one hash of the whole sequence
if there are fewer words. Hashes have 64 bits; that two shingles of a corpus share one
where it matters is far less likely than a fault of the machine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

WORDS = 5
BATCH_BYTES = 1 << 20

_space = np.zeros(256, bool)
_space[[0x20, *range(0x09, 0x0E)]] = True

_random = np.random.Generator(np.random.PCG64(20240607))
_letter = _random.integers(1, 1 << 64, 256, np.uint64)
_letter[ord("A") : ord("Z") + 1] = _letter[ord("a") : ord("z") + 1]
_place = _random.integers(1, 1 << 64, WORDS, np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, size: int) -> np.ndarray:
    powers = np.full(size, base, np.uint64)
    powers[0] = 1
    return np.multiply.accumulate(powers)


_up, _down = _powers(_BASE, BATCH_BYTES + 2), _powers(_INVERSE, BATCH_BYTES + 2)


def mix(values: np.ndarray) -> np.ndarray:
    """Spreads all bits over all bits."""
    values = (values ^ values >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ values >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return values ^ values >> np.uint64(31)


def _word_hashes(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each word."""
    global _up, _down
    if len(text) + 1 > len(_up):  # one word longer than a batch
        _up, _down = _powers(_BASE, len(text) + 2), _powers(_INVERSE, len(text) + 2)
    edge = np.flatnonzero(np.diff(_space[text], prepend=True, append=True))
    start, end = edge[::2], edge[1::2]
    total = np.zeros(len(text) + 1, np.uint64)
    np.cumsum(_letter[text] * _up[: len(text)], out=total[1:])
    return start, mix((total[end] - total[start]) * _down[start])


def _pieces(text: np.ndarray) -> Iterator[np.ndarray]:
    """A long text in parts that end at white space."""
    at = 0
    while at < len(text):
        end = at + BATCH_BYTES
        while end < len(text) and not _space[text[end]]:
            end += 1
        yield text[at:end]
        at = end


def _window_hashes(words: np.ndarray) -> np.ndarray:
    size = len(words) - WORDS + 1
    total = np.zeros(max(size, 0), np.uint64)
    for k in range(WORDS if size > 0 else 0):
        total += words[k : k + size] * _place[k]
    return mix(total)


def _whole_hash(words: np.ndarray) -> np.ndarray:
    """Of one to four words; their number takes part."""
    return mix((words * _place[: len(words)]).sum(keepdims=True) + np.uint64(len(words)))


def _set(words: np.ndarray, windows: np.ndarray) -> np.ndarray:
    if len(words) >= WORDS:
        return np.unique(windows)
    return _whole_hash(words) if len(words) else np.empty(0, np.uint64)


def _sets(texts: list[bytes]) -> Iterator[np.ndarray]:
    joined = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    starts, words = _word_hashes(joined)
    windows = _window_hashes(words)
    bounds = np.cumsum([0, *(len(text) + 1 for text in texts)])
    first = np.searchsorted(starts, bounds).tolist()
    for a, b in zip(first[:-1], first[1:], strict=True):
        yield _set(words[a:b], windows[a : max(a, b - WORDS + 1)])


def shingle_sets(texts: list[bytes]) -> Iterator[np.ndarray]:
    """The sorted set of each text, in order."""
    some, size = [], 0
    for text in texts:
        if some and size + len(text) >= BATCH_BYTES:
            yield from _sets(some)
            some, size = [], 0
        if len(text) >= BATCH_BYTES - 1:
            words = np.concatenate([_word_hashes(p)[1] for p in _pieces(np.frombuffer(text, np.uint8))])
            yield _set(words, _window_hashes(words))
        else:
            some.append(text)
            size += len(text) + 1
    if some:
        yield from _sets(some)


def word_groups(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashes of the words of some texts at a time, in order, and where the words of each begin and the last ones end."""
    at = 0
    while at < len(texts):
        some, size = [], 0
        while at < len(texts) and (not some or size + len(texts[at]) < BATCH_BYTES):
            some.append(texts[at])
            size += len(texts[at]) + 1
            at += 1
        if len(some) == 1 and size >= BATCH_BYTES:  # a long text
            words = np.concatenate([_word_hashes(p)[1] for p in _pieces(np.frombuffer(some[0], np.uint8))])
            yield words, np.array([0, len(words)])
        else:
            starts, words = _word_hashes(np.frombuffer(b" ".join(some) + b" ", np.uint8))
            yield words, np.searchsorted(starts, np.cumsum([0, *(len(text) + 1 for text in some)]))
