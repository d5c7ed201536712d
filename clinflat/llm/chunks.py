"""Cutting texts into chunks that encode alone, with a bounded cache of encoded chunks.

Patterns of byte-level tokenizers join a space only to the character after it. So a text may be
cut before each space that stands before a character other than white space: no token spans the
cut, and equal chunks have equal tokens wherever they stand.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

CUT = re.compile(r" (?=\S)")
MARKS = frozenset(".,;:!?")


class ChunkCache:
    """Encodes texts through a function that encodes distinct chunks; results are packed bytes."""

    def __init__(
        self, encode: Callable[[list[str]], list[bytes]], size: int = 600_000, longest: int = 128
    ) -> None:
        self.encode, self.size, self.longest = encode, size, longest
        self.known: dict[str, bytes] = {}

    def texts(self, texts: Sequence[str]) -> list[bytes]:
        if len(self.known) > self.size:
            self.known.clear()
        known, get = self.known, self.known.get
        cut: list[tuple[list[bytes | None], list[tuple[int, str]]]] = []
        new: set[str] = set()
        for text in texts:
            # the first chunk has no space before it: it is kept under its text after a space
            parts = text.split(" ")
            parts[0] = " " + parts[0]
            found = list(map(get, parts))
            lost: list[tuple[int, str]] = []
            if None in found:
                lost = [(k, p) for k, p in enumerate(parts) if found[k] is None]
                if any(k and (not p or p[0].isspace()) for k, p in lost):
                    parts = CUT.split(text)
                    parts[0] = " " + parts[0]
                    found = list(map(get, parts))
                    lost = [(k, p) for k, p in enumerate(parts) if found[k] is None]
                new.update([p for _, p in lost])
            cut.append((found, lost))
        extra: dict[str, bytes] = {}
        if new:
            fresh = list(new)
            packed = self.encode([p[1:] if p[0] == " " else " " + p for p in fresh])
            for part, ids in zip(fresh, packed):
                extra[part] = ids
                if len(part) <= self.longest:
                    known[part] = ids
        for found, lost in cut:
            for k, p in lost:
                found[k] = extra[p]
        return [b"".join(found) for found, _ in cut]


def pieces_of(chunk: str, find: Callable[[str], list[str]]) -> list[str]:
    """find(chunk); letters after at most one space, and a mark after them, need no pattern."""
    word = chunk[1:] if chunk[:1] == " " else chunk
    if word.isalpha():
        return [chunk]
    if word[-1:] in MARKS and word[:-1].isalpha():
        return [chunk[:-1], chunk[-1]]
    return find(chunk)
