"""Word shingles as sorted 64-bit hashes, computed for whole Arrow batches with numpy.

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z, which is what splitting the UTF-8
bytes at ASCII white space gives. A document's set holds its distinct windows of ``width``
words; with fewer words the whole sequence is the only element; without words it is empty.
"""

from __future__ import annotations

import numpy as np
import xxhash

from lakeloom.llm.memory import claim, remembered

REMEMBER_WORDS = 150_000
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], dtype=np.uint64)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < REMEMBER_WORDS:
            self[word] = value
        return value


_hashes = remembered(_Hashes())


def begin_task() -> None:
    claim(_hashes)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, width: int = 5) -> np.ndarray:
    """The sorted distinct shingle hashes (int64) of one text."""
    found = (text or "").encode().lower().split()
    if not found:
        return np.empty(0, np.int64)
    h = np.fromiter(map(_hashes.__getitem__, found), np.uint64, len(found))
    size = min(width, len(h))
    total = np.full(len(h) - size + 1, size, dtype=np.uint64)
    for i in range(size):
        total += mixed(h[i : len(h) - size + 1 + i] * _MULTIPLIERS[i % len(_MULTIPLIERS)] + np.uint64(i))
    return np.unique(mixed(total).view(np.int64))


def signature(shingles: np.ndarray) -> int:
    """A 64-bit name of the set: equal sets have equal names."""
    u = shingles.view(np.uint64)
    parts = np.array([u.sum(dtype=np.uint64), mixed(u).sum(dtype=np.uint64), len(u)], dtype=np.uint64)
    return int(mixed(parts * _MULTIPLIERS[:3]).sum(dtype=np.uint64).view(np.int64))
