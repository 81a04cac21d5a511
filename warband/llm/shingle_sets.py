"""Word-shingle sets of texts as 64-bit hashes, a batch at a time."""

from __future__ import annotations

import numpy as np
import xxhash

SHINGLE = 4
MAX_WORDS = 150_000


class WordHashes(dict):
    """Word → 64-bit hash, remembered."""

    def __missing__(self, w: bytes) -> int:
        h = self[w] = xxhash.xxh3_64_intdigest(w)
        return h


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the finalizer of a published 64-bit hash)."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def words_of(text: bytes) -> list[bytes]:
    """Words of an UTF-8 text: A-Z lower-cased, cut at the bytes 0x20 and 0x09 to 0x0D."""
    return text.lower().split()


def shingle_rows(texts: list[bytes | None], known: WordHashes, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text index) of all shingles, repeats included; a text with fewer than ``size`` words has its
    whole word sequence as one shingle, a text without words none."""
    if len(known) > MAX_WORDS:
        known.clear()
    words: list[bytes] = []
    counts = np.zeros(len(texts), np.int64)
    for i, t in enumerate(texts):
        if t:
            found = words_of(t)
            counts[i] = len(found)
            words += found
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    ends = np.cumsum(counts)
    owner = np.repeat(np.arange(len(texts)), counts)
    last = np.repeat(ends, counts)
    at = np.flatnonzero(np.arange(len(h)) + size <= last)
    value = np.zeros(len(at), np.uint64)
    for k in range(size):
        value = _mix(value + h[at + k] + np.uint64(k + 1))
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        extra = np.empty(len(short), np.uint64)
        for j, i in enumerate(short.tolist()):
            v = np.zeros(1, np.uint64)
            for k in range(int(counts[i])):
                v = _mix(v + h[ends[i] - counts[i] + k] + np.uint64(k + 1))
            extra[j] = _mix(v + np.uint64(int(counts[i]) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))[0]
        return np.r_[value, extra], np.r_[owner[at], short]
    return value, owner[at]


def shingle_sets(texts: list[bytes | None], known: WordHashes, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, ascending inside each text, and the offsets of each text."""
    value, owner = shingle_rows(texts, known, size)
    by = np.argsort(value)
    small = owner.astype(np.uint16) if len(texts) <= 1 << 16 else owner      # short keys sort in linear time
    by = by[np.argsort(small[by], kind="stable")]
    value, owner = value[by], owner[by]
    if len(value):
        new = np.r_[True, (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])]
        value, owner = value[new], owner[new]
    return value, np.r_[0, np.cumsum(np.bincount(owner, minlength=len(texts)))]
