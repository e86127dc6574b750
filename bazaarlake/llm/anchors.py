"""Cutting texts so that equal strings of a fixed length meet: each start belongs to the rarest-hashed n-gram that follows.

Of the n-grams inside a string of LENGTH bytes the one with the smallest hash (the first of equal ones) is its anchor;
equal strings have the same anchor at the same place. Starts that share an anchor form a run, whose strings
together are one fragment of the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash

LENGTH = 100
GRAM = 24
# Starts that are handled at once; a longer text is cut into such parts (their strings overlap).
PART = 1 << 20

_STEP = np.uint64(0x9E3779B97F4A7C15)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM (24) bytes from each position on, built from hashes of 1, 2, 4, 8 and 16 bytes."""
    h = {1: data.astype(np.uint64) + np.uint64(1)}
    power = {1: _STEP}
    with np.errstate(over="ignore"):
        for n in (1, 2, 4, 8):
            h[2 * n] = h[n][:-n] * power[n] + h[n][n:]
            power[2 * n] = power[n] * power[n]
        found = h[16][: len(data) - GRAM + 1] * power[8] + h[8][16:]
        found ^= found >> np.uint64(29)
        found *= np.uint64(0xBF58476D1CE4E5B9)
        found ^= found >> np.uint64(32)
    return found


def smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values."""
    size, found = 1, values
    while size * 2 <= width:
        found = np.minimum(found[:-size], found[size:])
        size *= 2
    rest = width - size
    return np.minimum(found[: len(found) - rest], found[rest:]) if rest else found


def runs(data: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Arrays (anchor hash, fragment hash, first start, number of starts) for every part of a text of LENGTH bytes or more."""
    whole, view = np.frombuffer(data, np.uint8), memoryview(data)
    for at in range(0, len(data) - LENGTH + 1, PART):
        part = whole[at : at + PART + LENGTH - 1]
        hashes = gram_hashes(part)
        # The place in the low bits lets the first of equal hashes win.
        place = np.arange(len(hashes), dtype=np.uint64)
        least = smallest(hashes & ~np.uint64(0x1FFFFF) | place, LENGTH - GRAM + 1)
        starts = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
        sizes = np.diff(np.r_[starts, len(least)])
        anchors = hashes[(least[starts] & np.uint64(0x1FFFFF)).astype(np.int64)]
        digest, starts = xxhash.xxh3_64_intdigest, starts + at
        ends = starts + sizes + LENGTH - 1
        fragments = [digest(view[a:b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        yield anchors.view(np.int64), np.array(fragments, np.uint64).view(np.int64), starts, sizes
