"""MinHash signatures and LSH band buckets.

Base hash of a shingle: the first 8 hex digits of its MD5 (32 bits) — the same value in
any SQL engine. Permutation ``i`` maps ``h`` to ``(a_i·h + b_i) mod (2^31 − 1)``; with
``a_i, b_i < 2^31`` and ``h < 2^32`` the product stays inside a signed 64-bit integer.
The constants follow from a rule (MD5 of ``'a<i>'`` / ``'b<i>'``), not from a table.

Work per sequence stays inside its row (no explode, no shuffle). Identical sequences get
identical signatures, so the callers hash each distinct sequence once.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PRIME = 2_147_483_647  # 2^31 − 1
EMPTY_SHINGLE = ""     # stands for a sequence with no shingle: all such sequences collide


def _md5_int(text: str) -> int:
    return int(hashlib.md5(text.encode("utf-8")).hexdigest()[:8], 16)


def permutations(num_perm: int = 128) -> list[tuple[int, int]]:
    return [(1 + _md5_int(f"a{i}") % (PRIME - 1), _md5_int(f"b{i}") % PRIME) for i in range(num_perm)]


def base_hash(c: Column) -> Column:
    return F.conv(F.substring(F.md5(c), 1, 8), 16, 10).cast("bigint")


def _min_hash_kernel(num_perm: int):
    """Arrow batch kernel: rows of base hashes → rows of ``num_perm`` permuted minima.

    The whole batch is one flat array; each permutation is a vectorized multiply-add-mod
    over it and ``np.minimum.reduceat`` takes the per-row minima, in slices of about 64k
    hashes so memory stays bounded. No per-row Python loop.
    """
    ab = np.array(permutations(num_perm), dtype=np.int64)
    a, b = ab[:, :1], ab[:, 1:]

    @F.pandas_udf(T.ArrayType(T.LongType()))
    def kernel(hashes: pd.Series) -> pd.Series:
        lens = hashes.map(len).to_numpy()
        flat = np.concatenate(hashes.to_numpy()).astype(np.int64) if len(hashes) else np.zeros(0, np.int64)
        starts = np.concatenate([[0], np.cumsum(lens)[:-1]])
        out = np.empty((len(hashes), num_perm), dtype=np.int64)
        row = 0
        while row < len(hashes):
            end = row + 1
            while end < len(hashes) and starts[end] + lens[end] - starts[row] <= 65536:
                end += 1
            lo, hi = starts[row], starts[end - 1] + lens[end - 1]
            vals = (a * flat[None, lo:hi] + b) % PRIME
            out[row:end] = np.minimum.reduceat(vals, starts[row:end] - lo, axis=1).T
            row = end
        return pd.Series(list(out))
    return kernel


def signature(shingles: Column, num_perm: int = 128) -> Column:
    """U4: array of ``num_perm`` minima over the distinct shingles.

    Base hashes are a Spark expression (MD5, once per shingle); the permuted minima run in
    the vectorized batch kernel above. An empty shingle set hashes the sentinel shingle.
    """
    sh = F.array_distinct(shingles)
    sh = F.when(F.size(sh) > 0, sh).otherwise(F.array(F.lit(EMPTY_SHINGLE)))
    return _min_hash_kernel(num_perm)(F.transform(sh, base_hash))


@functools.lru_cache(maxsize=None)
def band_layout(threshold: float = 0.5, num_perm: int = 128) -> tuple[int, int]:
    """(bands, rows) minimising the equally weighted false-positive and false-negative areas."""
    def area(f, lo, hi, steps=200):
        w = (hi - lo) / steps
        return sum(f(lo + (k + 0.5) * w) for k in range(steps)) * w
    best, best_err = (1, 1), float("inf")
    for b in range(1, num_perm + 1):
        for r in range(1, num_perm // b + 1):
            fp = area(lambda s: 1 - (1 - s ** r) ** b, 0.0, threshold)
            fn = area(lambda s: 1 - (1 - (1 - s ** r) ** b), threshold, 1.0)
            err = 0.5 * fp + 0.5 * fn
            if err < best_err:
                best, best_err = (b, r), err
    return best


def band_buckets(df: DataFrame, key_cols: list[str], sig_col: str = "sig", bands: int = 25,
                 rows: int = 5) -> DataFrame:
    """One row per (key, band) with the band's signature slice as its bucket.

    Two sequences are LSH candidates iff they share a (band, bucket) row — an equi-join key.
    """
    sig = F.col(sig_col)
    return df.select(*key_cols, F.posexplode(F.transform(
        F.sequence(F.lit(0), F.lit(bands - 1)), lambda j: F.slice(sig, j * rows + 1, rows))).alias("band", "bucket"))
