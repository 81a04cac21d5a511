"""Large groups settled against samples: the labels that one task finds, and work that follows the points."""

import random

import pytest
from pyspark.sql import functions as F

from warband.operators import dbscan as module
from warband.operators.dbscan import dbscan


def _clouds(seed, n):
    """Dense and thin clouds, bridges between them, single points, copies and an empty vector."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        kind = rng.random()
        at = rng.choice([0, 0, 0, 3, 6])
        vec = {at: 40, at + 1: 40 if kind < 0.5 else rng.randint(0, 40)}
        if kind > 0.8:
            vec[rng.randint(0, 9)] = rng.randint(1, 40)
        if kind > 0.97:
            vec = {k: rng.randint(0, 9) for k in range(10)}
        vec[rng.randint(0, 9)] = vec.get(rng.randint(0, 9), 0) + rng.randint(0, 9)
        vec = {k: c for k, c in vec.items() if c}
        rows.append((i, rng.choice([1, 1, 1, 2]), sorted(vec), [vec[k] for k in sorted(vec)]))
    rows.append((n, 5, [], []))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,eps,samples", [(1, 0.02, 6), (2, 0.05, 12), (3, 0.005, 4)])
def test_samples_find_what_one_task_finds(spark, seed, eps, samples):
    pts = spark.createDataFrame(_clouds(seed, 400), "sid long, weight long, grams array<long>, cnts array<int>")
    members = pts.select(F.lit(5).cast("long").alias("g"), "sid").union(pts.where("sid % 3 > 0").select(F.lit(6).cast("long"), "sid"))
    want = {(r.g, r.sid): r.label for r in dbscan(members, pts, eps, samples).collect()}
    got = {(r.g, r.sid): r.label for r in dbscan(members, pts, eps, samples, block_size=32, task_points=20, sample_points=12).collect()}
    assert got == want and len(set(want.values())) > 1 and len(want) < members.count()


def test_dense_groups_do_not_meet_in_pairs(spark, monkeypatch):
    moved = []
    real = module._block_pairs
    monkeypatch.setattr(module, "_block_pairs", lambda slots, points: (moved.append(slots.agg(F.sum("mine")).first()[0] or 0), real(slots, points))[1])
    pts = spark.range(6_000).select(F.col("id").alias("sid"), F.lit(1).cast("long").alias("weight"), F.array(*map(F.lit, range(3))).cast("array<long>").alias("grams"),
                                    F.array(F.lit(90), (F.col("id") % 31).cast("int") + 1, (F.col("id") % 37).cast("int") + 1).alias("cnts"))
    labels = dbscan(pts.select(F.lit(0).cast("long").alias("g"), "sid"), pts, 0.05, 5, block_size=64)
    assert labels.count() == 6_000 and labels.select("label").distinct().count() == 1
    assert sum(moved) < 6_000 * 20
