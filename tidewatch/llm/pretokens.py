"""Pre-tokens of byte-level BPE, cut with few regular-expression calls.

The pattern only joins a space to what follows it. A text is therefore cut at its spaces into
chunks, each chunk but the first with its space in front, and pre-tokens never cross a chunk,
unless white space stands on both sides of a space (or it ends the text after white space). Such
texts are one chunk. Equal chunks of many texts are split once.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Hashable

#: Fixed value: the public split pattern of the vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Unicode versions of libraries differ beyond the first alphabets only.
OLD_LETTERS = "԰"

#: Entries of a worker's cache; it is emptied when full.
CACHE_ENTRIES = 200_000

_RUN = re.compile(r"\s (?:\s|\Z)")


def chunks(text: str) -> tuple[str, list[str]]:
    """The first chunk as it is, and the others without the space in front of each."""
    if _RUN.search(text):
        return text, []
    first, *rest = text.split(" ")
    return first, rest


class ChunkCache:
    """Values of chunks, computed once per chunk while they fit."""

    def __init__(self, compute: Callable[[str], Hashable], entries: int = CACHE_ENTRIES):
        self.compute, self.entries, self.known = compute, entries, {}

    def values(self, text: str) -> tuple[Hashable, list]:
        """The value of the first chunk, and those of the others."""
        first, rest = chunks(text)
        known = self.known
        if len(known) > self.entries:
            known.clear()
        for chunk in set(rest).difference(known):
            known[chunk] = self.compute(" " + chunk)
        return self.compute(first), list(map(known.__getitem__, rest))
