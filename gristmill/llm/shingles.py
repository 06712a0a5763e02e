"""Hashed word shingles of a text, computed in segments so that a very long text needs little beside its result."""

from __future__ import annotations

import functools

import numpy as np

# Bytes of a text that are hashed at a time.
SEGMENT = 1 << 18
_BASE = 0x5851F42D4C957F2D
_ALL = (1 << 64) - 1
_U = np.uint64


@functools.lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, as many as a segment needs."""
    up, down = np.full(SEGMENT + 1, _U(_BASE)), np.full(SEGMENT + 1, _U(pow(_BASE, -1, 1 << 64)))
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(32))) * _U(0x9E3779B97F4A7C15)
    h = (h ^ (h >> _U(29))) * _U(0xBF58476D1CE4E5B9)
    return h ^ (h >> _U(32))


def word_hashes(raw: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words of UTF-8 bytes; words are divided by ASCII white space."""
    up, down = _powers()
    found, open_hash, open_bytes = [], 0, 0  # a word may go on from the segment before
    for at in range(0, len(raw), SEGMENT):
        part = raw[at : at + SEGMENT]
        space = np.empty(len(part) + 2, bool)
        space[0] = space[-1] = True
        space[1:-1] = (part == 32) | ((part >= 9) & (part <= 13))
        edge = np.diff(space.view(np.int8))
        start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + _U(1)) * up[: len(part)], dtype=np.uint64, out=sums[1:])
        words = (sums[end] - sums[start]) * down[start]
        if open_bytes:
            if len(start) and start[0] == 0:
                words[0] = (open_hash + int(words[0]) * pow(_BASE, open_bytes, 1 << 64)) & _ALL
            else:
                words, start, end = np.r_[_U(open_hash), words], np.r_[0, start], np.r_[0, end]
        goes_on = len(end) and end[-1] == len(part) and at + SEGMENT < len(raw)
        if goes_on:
            open_bytes = int(end[-1] - start[-1]) + (open_bytes if start[-1] == 0 else 0)
            open_hash = int(words[-1])
            words = words[:-1]
        else:
            open_hash = open_bytes = 0
        found.append(words)
    return mixed(np.concatenate(found)) if found else np.empty(0, np.uint64)


def shingle_hashes(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a text, A-Z lower-cased; null has none.

    Fewer words than `width` make one shingle of all of them; no words make none.
    """
    words = word_hashes(np.frombuffer((text or "").encode().lower(), np.uint8))  # bytes.lower() changes A-Z only
    if not len(words):
        return words
    n = max(1, len(words) - width + 1)
    shingles = np.zeros(n, np.uint64)
    for i in range(min(width, len(words))):
        shingles = mixed(shingles * _U(3) + words[i : i + n])
    return np.unique(shingles)
