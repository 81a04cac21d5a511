"""Whitening of integer-scaled embeddings: pivoted Cholesky of the centred scatter, then one-sided Jacobi.

Every task sums its rows around whole numbers near their own mean, where the products are exact, and
states (rows, sums, scatter) of tasks are merged in a tree: the scatter of two parts is the sum of theirs
plus ``n_a·n_b/(n_a+n_b)`` times the outer product of the difference of their means. So one scan gives the
centred scatter, and what reaches the driver is one matrix of the vectors' dimension.

The scatter ``A`` is factored with diagonal pivoting, ``PᵀAP = LLᵀ``. Plane rotations from the right make the
columns of ``L`` orthogonal (Hestenes' one-sided Jacobi method, run on the triangular factor itself):
``L·J = U·Σ`` gives ``A = (PU)Σ²(PU)ᵀ``, so squared column norms are the eigenvalues and normalised columns the
components, small ones to high relative accuracy.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from warband.llm.common import regular_vectors
from warband.session import materialize

SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8
MAX_DIMENSION = 4_096       # the scatter matrix is held by the driver; longer vectors raise
FAN_IN = 32                 # states merged by one task
LARGEST = float(1 << 40)    # entries whose scaled value is not below this can't be summed exactly


def merged(a, b):
    """Merge two states (n, sums, scatter), the sums as Python integers."""
    if a is None or b is None:
        return b if a is None else a
    (n, s, c), (m, t, d) = a, b
    gap = np.array([float(y * n - x * m) for x, y in zip(s, t)]) / n / m     # difference of the means, exact sums
    return n + m, [x + y for x, y in zip(s, t)], c + d + np.outer(gap, gap) * (n / (n + m) * m)


def state_of(x: np.ndarray):
    """State of int64 rows [n, dim]."""
    mid = np.rint(x.mean(axis=0)).astype(np.int64)
    rest = (x - mid).sum(axis=0)
    sums = [int(r) + int(m) * len(x) for r, m in zip(rest, mid)]
    y, rest = (x - mid).astype(np.float64), rest.astype(np.float64)
    return len(x), sums, y.T @ y - np.outer(rest, rest) / len(x)


def pivoted_cholesky(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``L`` [dim, rank] and the pivot order ``p`` with ``a[p][:, p] = L Lᵀ``, up to rounding."""
    a, d = a.copy(), len(a)
    p, low = np.arange(d), np.zeros((d, d))
    floor = np.finfo(float).eps * d * max(a.diagonal().max(initial=0.0), 0.0)
    for k in range(d):
        j = k + int(np.argmax(a.diagonal()[k:]))
        if not a[j, j] > floor:
            return low[:, :k], p
        if j != k:
            a[[k, j]], p[[k, j]], low[[k, j]] = a[[j, k]], p[[j, k]], low[[j, k]]
            a[:, [k, j]] = a[:, [j, k]]
        low[k, k] = np.sqrt(a[k, k])
        low[k + 1:, k] = a[k + 1:, k] / low[k, k]
        a[k + 1:, k + 1:] -= np.outer(low[k + 1:, k], low[k + 1:, k])
    return low, p


def one_sided_jacobi(low: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """(squared column norms falling, unit columns) after rotating the columns of ``low`` orthogonal.

    A sweep meets every pair of columns once, as rounds of disjoint pairs (a round-robin tournament) that
    are rotated together."""
    w = np.ascontiguousarray(low.T)
    n = len(w)
    order = np.arange(n + n % 2)             # index n, where there is one, sits out
    tiny = np.finfo(float).eps
    for _ in range(sweeps):
        calm = True
        for _ in range(len(order) - 1):
            i, j = order[:len(order) // 2], order[::-1][:len(order) // 2]
            real = (i < n) & (j < n)
            i, j = i[real], j[real]
            x, y = w[i], w[j]
            a, b, g = (x * x).sum(1), (y * y).sum(1), (x * y).sum(1)
            turn = np.abs(g) > tiny * np.sqrt(a * b)
            if turn.any():
                calm = False
                i, j, x, y, a, b, g = i[turn], j[turn], x[turn], y[turn], a[turn], b[turn], g[turn]
                z = (b - a) / (2 * g)
                t = np.where(z >= 0, 1.0, -1.0) / (np.abs(z) + np.hypot(1, z))
                c = 1 / np.hypot(1, t)
                s = c * t
                w[i], w[j] = c[:, None] * x - s[:, None] * y, s[:, None] * x + c[:, None] * y
            order[1:] = np.roll(order[1:], 1)
        if calm:
            break
    e = (w * w).sum(1)
    by = np.argsort(-e, kind="stable")
    return e[by], (w[by] / np.sqrt(e[by])[:, None]).T


def components_of(n: int, scatter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of ``scatter / n`` (falling, the positive ones) and unit components as columns; each
    component's entry of largest size is positive."""
    low, p = pivoted_cholesky(scatter)
    if not low.size:
        return np.zeros(0), np.zeros((len(scatter), 0))
    e, u = one_sided_jacobi(low)
    out = np.empty_like(u)
    out[p] = u
    out *= np.where(out[np.abs(out).argmax(axis=0), np.arange(out.shape[1])] < 0, -1.0, 1.0)
    return e / n, out


def _rows(column: pa.Array, dim: int) -> np.ndarray:
    """int64 rows of scaled vectors."""
    return np.asarray(column.flatten()).reshape(-1, dim).astype(np.int64)


def _packed(part: int, state) -> pa.RecordBatch:
    n, sums, scatter = state
    return pa.RecordBatch.from_arrays(
        [pa.array([part], pa.int64()), pa.array([n], pa.int64()), pa.array([list(map(str, sums))], pa.list_(pa.string())),
         pa.array([scatter.ravel()], pa.list_(pa.float64()))], names=["part", "n", "sums", "scatter"])


def _unpacked(n, sums, scatter):
    return n, [int(x) for x in sums], np.array(scatter, float).reshape(len(sums), len(sums))


def _fold(states: DataFrame):
    """Merge the tasks' states in a tree, ``FAN_IN`` at a time."""
    def merge(key, table):
        total = None
        for batch in table.to_batches():
            for i in range(batch.num_rows):
                total = merged(total, _unpacked(*(batch.column(c)[i].as_py() for c in ("n", "sums", "scatter"))))
        return pa.Table.from_batches([_packed(key[0].as_py(), total)])

    states = materialize(states, "whitening-states")
    last = states.agg(F.max("part")).first()[0]
    while last:
        grouped = states.withColumn("part", F.floor(F.col("part") / FAN_IN).cast("bigint")).groupBy("part")
        states = materialize(grouped.applyInArrow(merge, STATE), "whitening-states")
        last //= FAN_IN
    total = None
    for row in states.select("n", "sums", "scatter").collect():      # one row, or none of an empty table
        total = merged(total, _unpacked(*row))
    return total


STATE = "part bigint, n bigint, sums array<string>, scatter array<double>"


def _states(x: DataFrame, dim: int) -> DataFrame:
    def run(batches):
        from pyspark import TaskContext
        total = None
        for b in batches:
            if b.num_rows:
                total = merged(total, state_of(_rows(b.column(0), dim)))
        if total is not None:
            yield _packed(TaskContext.get().partitionId(), total)
    return x.select("x").mapInArrow(run, STATE)


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS,
           scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """Per usable row and component (numbered from 1 by falling eigenvalue): id, ``component``, ``n``,
    ``deviation``, ``whitened``, ``explained``, ``identity_error``.

    An entry ``c`` counts as the whole number ``floor(scale·c) + offset``. Every usable row is in the fit.
    ``deviation`` is the exact sum over dimensions of ``(n·x − S)²`` as decimal(38, 0); ``whitened`` the
    centred row on the component over the square root of its eigenvalue; ``explained`` the eigenvalue's
    share of the covariance's trace; ``identity_error`` the largest entry of the whitened rows' measured
    covariance minus the identity, the same on all rows.

    Rows go whose vector is null, or holds null or non-finite entries, or entries of 2^40 and more after
    scaling (no exact sums); so do vectors of another length than the commonest (of equally common ones the
    longest). Repeated rows, null ids included, count each. Components with no variance are not given: a
    table of equal vectors, one row, or an empty table gives an empty result. Extra columns are not read.
    Vectors over ``MAX_DIMENSION`` raise. Equal eigenvalues leave the choice of their components open; all
    rows get the same. Two scans fit and check, one writes; tasks hold one batch and one matrix.
    """
    rows, dim = regular_vectors(vectors, id_col, vector_col)
    schema = (f"`{id_col}` {vectors.schema[id_col].dataType.simpleString()}, component int, n bigint, deviation decimal(38,0), "
              "whitened double, explained double, identity_error double")
    spark = vectors.sparkSession
    if dim > MAX_DIMENSION:
        raise ValueError(f"vectors of {dim} entries; the scatter of at most {MAX_DIMENSION} is held by the driver")
    scaled = rows.select("id", F.transform("v", lambda c: F.floor(c * scale).cast("double") + offset).alias("x")).where(
        F.forall("x", lambda c: F.abs(c) < LARGEST))
    state = _fold(_states(scaled, dim)) if dim else None
    if state is None:
        return spark.createDataFrame([], schema)
    n, sums, scatter = state
    values, axes = components_of(n, scatter)
    trace = float(np.trace(scatter)) / n
    values, axes = values[:components], axes[:, :components]
    if not len(values):
        return spark.createDataFrame([], schema)
    whole = np.array([s // n for s in sums], np.int64)          # mean = whole + part
    part = np.array([s % n / n for s in sums])
    lead = np.array([s % n for s in sums], np.int64)            # n·x − S = n·(x − whole) − lead
    k = len(values)

    def project(x):
        return ((x - whole).astype(float) - part) @ axes / np.sqrt(values)

    def checked(batches):
        """States of the whitened rows, whose mean is about zero: sums are carried inside the products."""
        from pyspark import TaskContext
        m, first, second = 0, np.zeros(k), np.zeros((k, k))
        for b in batches:
            if b.num_rows:
                w = project(_rows(b.column(0), dim))
                m, first, second = m + len(w), first + w.sum(0), second + w.T @ w
        if m:
            yield pa.RecordBatch.from_arrays([pa.array(np.full(k * k, TaskContext.get().partitionId())),
                                              pa.array(np.repeat(np.arange(k), k)), pa.array(np.tile(np.arange(k), k)),
                                              pa.array(np.repeat(first, k)), pa.array(second.ravel())],
                                             names=["part", "i", "j", "first", "second"])

    sums_of = (scaled.select("x").mapInArrow(checked, "part bigint, i bigint, j bigint, first double, second double")
               .groupBy("i", "j").agg(F.sum("first").alias("first"), F.sum("second").alias("second"))).collect()   # k² rows
    first, second = np.zeros(k), np.zeros((k, k))
    for r in sums_of:
        first[r.i], second[r.i, r.j] = r.first, r.second
    error = float(np.abs(second / n - np.outer(first, first) / n / n - np.eye(k)).max())
    explained = values / trace
    exact_below = np.sqrt((1 << 62) / dim)                      # sizes whose squares add up in 64 bits

    def write(batches):
        import decimal
        for b in batches:
            if not b.num_rows:
                continue
            x = _rows(b.column(1), dim)
            away = x - whole
            if np.abs(away).max(initial=0) * float(n) + n < exact_below:
                d = away * n - lead
                deviation = [decimal.Decimal(v) for v in (d * d).sum(axis=1).tolist()]
            else:
                deviation = [decimal.Decimal(sum((int(a) * n - int(s)) ** 2 for a, s in zip(row, lead))) for row in away]
            w = project(x)
            at = np.repeat(np.arange(len(x)), k)
            big = [v if v < 10 ** 38 else None for v in deviation]
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(at)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                 pa.array(np.full(len(at), n)), pa.array(big, pa.decimal128(38, 0)).take(pa.array(at)), pa.array(w.ravel()),
                 pa.array(np.tile(explained, len(x))), pa.array(np.full(len(at), error))],
                names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return scaled.select("id", "x").mapInArrow(write, schema)
