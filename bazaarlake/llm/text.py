"""Small text helpers for Python workers."""

from __future__ import annotations

import re
from collections.abc import Iterator

WORDS = re.compile(rb"[^\x20\x09-\x0D]+")
SPACE = re.compile(rb"[\x20\x09-\x0D]")
#: Lower-cases A to Z only.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def pieces(data: bytes, size: int = 1 << 20) -> Iterator[bytes]:
    """Consecutive pieces of at least ``size`` bytes that end at white space, so that no word is cut."""
    start = 0
    while start < len(data):
        end = SPACE.search(data, start + size)
        stop = end.end() if end else len(data)
        yield data[start:stop]
        start = stop
