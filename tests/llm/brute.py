"""Plain Python versions of what the operators compute, for small fixtures."""

from __future__ import annotations

import re
import string

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def lower(text: str | None) -> str:
    return (text or "").translate(_LOWER)


def shingles(text: str | None, width: int) -> frozenset:
    words = WORD.findall(lower(text))
    if len(words) < width:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def components(sets: dict[int, frozenset], percent: int = 80) -> dict[int, int]:
    top = {i: i for i in sets}

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for i in sets:
        for j in sets:
            both = len(sets[i] & sets[j])
            if j < i and both and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = root(i), root(j)
                top[max(a, b)] = min(a, b)
    return {i: root(i) for i in sets}
