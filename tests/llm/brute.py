"""Plain versions of what the operators compute."""

from __future__ import annotations

import re

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def shingles(text: str | None) -> frozenset:
    words = _WORD.findall(bytes(b | 32 if 65 <= b <= 90 else b for b in (text or "").encode()))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def components(sets: list[frozenset], linked) -> list[int]:
    """For each set the least index reachable by links."""
    least = list(range(len(sets)))
    changed = True
    while changed:
        changed = False
        for i in range(len(sets)):
            for j in range(i):
                if least[i] != least[j] and linked(sets[i], sets[j]):
                    low, high = sorted((least[i], least[j]))
                    least = [low if x == high else x for x in least]
                    changed = True
    return least


def similar(a: frozenset, b: frozenset) -> bool:
    return bool(a and b) and 100 * len(a & b) >= 80 * len(a | b)
