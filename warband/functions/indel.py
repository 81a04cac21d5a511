"""Normalized indel similarity ``2·LCS(a, b) / (|a| + |b|)`` (1.0 for two empty strings).

The length of the longest common subsequence comes from the bit-parallel recurrence of Hyyrö (2004), run for all
pairs of an Arrow batch at once: a pair's state is one row of 64-bit words, a step takes the next character of every
pair's first string, and the addition carries from word to word. Masks of a second string (which characters stand
where) are built once per distinct string of the batch. No Python code runs per row.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH_WORDS = 1 << 21        # words of masks, states or steps held at once
FULL = np.uint64(0xFFFF_FFFF_FFFF_FFFF)


def _code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts in a row, and their lengths."""
    flat = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    return flat, np.fromiter(map(len, texts), np.int64, len(texts))


def _padded(flat: np.ndarray, size: np.ndarray, fill: int) -> np.ndarray:
    out = np.full((len(size), int(size.max(initial=0))), fill, np.int64)
    out[np.arange(out.shape[1]) < size[:, None]] = flat
    return out


def _added(v: np.ndarray, u: np.ndarray) -> np.ndarray:
    """``v + u`` of rows of words, lowest first, the last carry dropped."""
    total = v + u
    carry = total < v
    while carry[:, :-1].any():
        up = np.zeros_like(carry)
        up[:, 1:] = carry[:, :-1]
        total = total + up
        carry = up & (total == 0)        # a carry goes on only where it made a full word zero
    return total


def _lcs(a: list[str], b: list[str], which: np.ndarray) -> np.ndarray:
    """LCS lengths of ``a[i]`` with ``b[which[i]]``."""
    flat_a, size_a = _code_points(a)
    flat_b, size_b = _code_points(b)
    letters, letter_b = np.unique(flat_b, return_inverse=True)
    letter_a = np.searchsorted(letters, flat_a)
    letter_a[(letter_a == len(letters)) | (letters[np.minimum(letter_a, len(letters) - 1)] != flat_a)] = len(letters)
    words = int(size_b.max(initial=0)) // 64 + 1
    masks = np.zeros((len(b), len(letters) + 1, words), np.uint64)      # the last letter stands for all others and the padding
    row = np.repeat(np.arange(len(b)), size_b)
    at = np.arange(len(flat_b)) - np.repeat(np.cumsum(size_b) - size_b, size_b)
    np.bitwise_or.at(masks, (row, letter_b, at // 64), np.uint64(1) << (at % 64).astype(np.uint64))
    steps = _padded(letter_a, size_a, len(letters))
    v = np.full((len(a), words), FULL)
    for column in steps.T:
        u = v & masks[which, column]
        v = _added(v, u) | (v & ~u)
    return np.bitwise_count(~v).sum(axis=1).astype(np.int64)            # bits past a string's end stay set


def indel_ratios(a: list[str], b: list[str]) -> np.ndarray:
    """Similarities of ``a[i]`` and ``b[i]``."""
    size = np.fromiter(map(len, a), np.int64, len(a)) + np.fromiter(map(len, b), np.int64, len(b))
    common = np.zeros(len(a), np.int64)
    by = sorted(range(len(a)), key=lambda i: (len(b[i]), b[i], len(a[i])))    # equal and equally long strings side by side
    lo = 0
    while lo < len(by):
        hi, seen, letters, longest = lo, set(), set(), 0
        while hi < len(by):
            extra = b[by[hi]] not in seen
            letters_now = letters | set(b[by[hi]]) if extra else letters
            words = len(b[by[hi]]) // 64 + 1
            longest = max(longest, len(a[by[hi]]))
            cells = max((len(seen) + extra) * (len(letters_now) + 1) * words, (hi - lo + 1) * max(words, longest))
            if hi > lo and cells > BATCH_WORDS:
                break
            seen.add(b[by[hi]])
            letters, hi = letters_now, hi + 1
        part = by[lo:hi]
        distinct = {t: i for i, t in enumerate(dict.fromkeys(b[i] for i in part))}
        common[part] = _lcs([a[i] for i in part], list(distinct), np.array([distinct[b[i]] for i in part]))
        lo = hi
    return np.divide(2.0 * common, size, out=np.ones(len(a)), where=size > 0)


@F.pandas_udf(T.DoubleType())
def indel_similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    out = pd.Series(np.nan, a.index, "float64")
    both = (a.notna() & b.notna()).to_numpy()
    out[both] = indel_ratios(a[both].tolist(), b[both].tolist())
    return out.astype(object).where(both, None)
