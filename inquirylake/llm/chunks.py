"""Texts cut before spaces, with the tokens of every part remembered.

In the pattern that byte-level tokenizers split texts by, no match crosses from a character that
isn't white space to a following space.  So a text may be cut before each such space, and equal
parts have equal tokens wherever they stand.
"""

from __future__ import annotations

from collections.abc import Callable

#: Parts that a worker remembers, and the longest of them in characters.
REMEMBERED, LONGEST = 600_000, 40


class Irregular(Exception):
    """The part ends in white space, so the text can't be cut after it."""


class Parts(dict):
    """Part without its leading space -> its token ids as little-endian unsigned 32-bit integers."""

    def __init__(self, encode: Callable[[str], bytes]):
        super().__init__()
        self.encode = encode

    def __missing__(self, part: str) -> bytes:
        if not part or part[-1].isspace():
            raise Irregular
        ids = self.encode(" " + part)
        if len(part) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.clear()
            self[part] = ids
        return ids


def encode(text: str, parts: Parts) -> bytes:
    """The ids of a whole text."""
    if not text:
        return b""
    first, *rest = text.split(" ")
    if not rest:
        return parts.encode(text)
    if not first or first[-1].isspace():
        return parts.encode(text)
    try:
        return parts.encode(first) + b"".join(map(parts.__getitem__, rest))
    except Irregular:
        return parts.encode(text)
