"""Whitening against a plain eigendecomposition in exact arithmetic."""

from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF01
from warband.llm.queries import op11_embedding_whitening
from warband.llm.tables import table
from warband.llm.whitening import components_of, merged, one_sided_jacobi, pivoted_cholesky, state_of, whiten


def brute(rows, k=8):
    """{id: (deviation, whitened)}, explained: plain numpy over the whole list."""
    x = np.array([[int(np.floor(1024 * float(c))) + 100_000 for c in v] for _, v in rows], dtype=object)
    n, s = len(x), x.sum(axis=0)
    centred = np.array((x - np.array([Fraction(int(t), n) for t in s])), dtype=float)
    e, u = np.linalg.eigh(centred.T @ centred / n)
    e, u = e[::-1], u[:, ::-1]
    dev = [int(sum((n * a - t) ** 2 for a, t in zip(row, s))) for row in x]
    return dev, centred @ u[:, :k] / np.sqrt(e[:k]), e[:k] / e.sum()


def test_query_equals_brute_force(spark):
    rows = [(r.vec_id, r.embedding) for r in table(spark, SF01, "embeddings").collect()]
    dev, white, explained = brute(rows)
    got = op11_embedding_whitening(spark, SF01).collect()
    assert len(got) == 8 * len(rows)
    at = {i: k for k, (i, _) in enumerate(rows)}
    mine = np.zeros_like(white)
    for r in got:
        assert r.n == len(rows) and r.deviation == dev[at[r.vec_id]]
        assert abs(r.explained / explained[r.component - 1] - 1) < 1e-9
        mine[at[r.vec_id], r.component - 1] = r.whitened
    mine *= np.sign((mine * white).sum(axis=0))
    assert np.abs(mine - white).max() < 1e-9
    assert {r.identity_error for r in got}.pop() < 1e-10 and len({r.identity_error for r in got}) == 1
    assert np.abs(mine.T @ mine / len(rows) - np.eye(8)).max() < 1e-9


@pytest.mark.parametrize("dim,rank", [(1, 1), (5, 5), (12, 7), (33, 33)])
def test_factor_and_rotations(dim, rank):
    rng = np.random.default_rng(dim)
    b = rng.standard_normal((dim, rank)) * np.logspace(0, -5, rank)
    a = b @ b.T
    low, p = pivoted_cholesky(a)
    assert low.shape[1] >= rank and np.allclose(low @ low.T, a[np.ix_(p, p)], atol=1e-13)
    assert np.allclose(np.triu(low, 1), 0)
    e, u = one_sided_jacobi(low)
    assert np.allclose(e[:rank], np.linalg.eigvalsh(a)[::-1][:rank], rtol=1e-8) and np.allclose(u.T @ u, np.eye(len(e)), atol=1e-6)
    values, axes = components_of(1, a)
    assert np.allclose(a @ axes[:, :rank], axes[:, :rank] * values[:rank], atol=1e-12)


def test_merged_states_equal_the_whole():
    x = np.random.default_rng(1).integers(99_000, 101_000, (500, 6))
    total = None
    for part in np.array_split(x, [1, 40, 41, 300]):
        total = merged(total, state_of(part))
    n, sums, scatter = total
    c = x - x.mean(axis=0)
    assert n == 500 and sums == x.sum(axis=0).tolist() and np.allclose(scatter, c.T @ c, rtol=1e-12)


def test_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, 0.1], 1), (2, [0.25, 0.4], 2), (2, [0.25, 0.4], 2), (None, [0.75, 0.3], 3), (4, None, 4), (5, [None, 1.0], 5),
            (6, [nan, 1.0], 6), (7, [inf, 1.0], 7), (8, [1.0], 8), (9, [], 9), (10, [1e30, 0.0], 10)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n int")
    got = whiten(df).collect()
    assert sorted((r.vec_id or 0, r.component) for r in got) == [(0, 1), (0, 2), (1, 1), (1, 2), (2, 1), (2, 1), (2, 2), (2, 2)]
    assert {r.n for r in got} == {4}
    dev, white, explained = brute([(r[0], r[1]) for r in rows[:4]], 2)
    assert sorted({int(r.deviation) for r in got}) == sorted(set(dev))
    assert {round(r.explained, 9) for r in got} == set(np.round(explained, 9))
    for empty in (df.limit(0), df.where("vec_id = 1"), df.where("vec_id = 2"), df.where("vec_id > 3"), df.where("vec_id = 9")):
        assert whiten(empty).count() == 0


def test_large_deviation_is_exact(spark):
    df = spark.range(40).select(F.col("id").alias("vec_id"), F.array(F.col("id") * 1e7, F.col("id") % 7 * 3e7).alias("embedding"))
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    dev, _, _ = brute(rows, 2)
    assert {r.vec_id: int(r.deviation) for r in whiten(df).collect()} == dict(zip((i for i, _ in rows), dev))


def test_many_tasks_are_merged_in_a_tree(spark):
    df = table(spark, SF01, "embeddings")
    one = {(r.vec_id, r.component): r.whitened for r in whiten(df.coalesce(1)).collect()}
    many = {(r.vec_id, r.component): r.whitened for r in whiten(df.repartition(70)).collect()}
    assert one.keys() == many.keys() and max(abs(one[k] - many[k]) for k in one) < 1e-9
