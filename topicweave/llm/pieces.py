"""Cutting texts where every GPT-style pattern cuts too, and remembering what became of the parts.

A single space with a non-space before or after it always begins a token of such patterns (`` ?\\p{L}+`` and the like), so a
text may be cut there and the parts encoded one by one. Parts repeat, so most come from a cache.
"""

from __future__ import annotations

import re
from collections.abc import Callable

# Python's \s holds every white space of Unicode, so what it calls no space is none for the tokenizers either.
_AMID_SPACES = re.compile(r"\s (?:\s|\Z)")
_CUT = re.compile(r"(?<=\S)(?= \S)")


def parts(text: str) -> tuple[str, list[str]]:
    """``first, rest``: ``text`` is ``first`` and then, for each of ``rest``, a space and that part. ``first`` and every part with
    its space can be encoded apart from each other."""
    if _AMID_SPACES.search(text):
        first, *rest = _CUT.split(text)
        return first, [x[1:] for x in rest]
    first, *rest = text.split(" ")
    return first, rest


class Remembered(dict):
    """Results of ``make`` by key, in two generations: when the young one is full it becomes the old one.

    At most ``2 * size`` results are held. ``remembered.__getitem__`` finds or makes one.
    """

    def __init__(self, make: Callable, size: int = 300_000):
        super().__init__()
        self.make, self.size, self.old = make, size, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        self.put(key, value)
        return value

    def put(self, key, value) -> None:
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = value
