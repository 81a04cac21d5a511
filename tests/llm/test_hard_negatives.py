"""Hard negatives against brute force over all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF01
from warband.llm import hard_negatives
from warband.llm.hard_negatives import mine_hard_negatives, open_scores, spanning_tree, trees_of
from warband.llm.queries import op13_hard_negatives
from warband.llm.tables import table

COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(rows, every=50):
    """Plain loops over (id, label, vector) rows."""
    good = {(i, lab, tuple(math.floor(256 * float(c)) for c in v)) for i, lab, v in rows
            if i is not None and lab is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)}
    out = []
    for i, lab, x in good:
        if i % every:
            continue
        scored = [(-sum(a * b for a, b in zip(x, y)), j, lab2) for j, lab2, y in good]
        pos = sorted({(s, j) for s, j, lab2 in scored if lab2 == lab and j != i})[:5]
        for s, j in pos:
            neg = sorted({(t, k) for t, k, lab2 in scored if lab2 != lab and 50 * -s <= 100 * -t <= 95 * -s})[:3]
            out += [(i, j, r + 1, k, -s, -t) for r, (t, k) in enumerate(neg)]
    return sorted(out)


def result(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.select(*COLUMNS).collect())


def test_query_equals_brute_force(spark):
    rows = [(r.vec_id, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label, r.embedding) for r in table(spark, SF01, "embeddings").collect()]
    got = result(op13_hard_negatives(spark, SF01))
    assert got == brute(rows) and len(got) > 50


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_ties_copies_and_near_anchors(spark, seed, monkeypatch):
    """Few distinct vectors, a third of all rows the same one, several trees and scans."""
    monkeypatch.setattr(hard_negatives, "BLOCK", 16)
    monkeypatch.setattr(hard_negatives, "BROADCAST_BYTES", 8 * 4 * 40)
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((6, 4))
    rows = []
    for i in range(400):
        v = centres[0] if i % 3 == 0 else centres[rng.integers(6)] + rng.standard_normal(4) * 0.01 * rng.integers(0, 3)
        rows.append((i, int(rng.integers(3)), v.tolist()))
    rows += rows[:7] + [(8, 1, [1.0, 2.0, 3.0, 4.0]), (8, 2, [1.0, 2.0, 3.0, 4.0])]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").repartition(5)
    assert result(mine_hard_negatives(df, anchor_every=5)) == brute(rows, 5)


def test_bounds_hold_and_spare_scores():
    """Along a tree every wanted pair is given with its exact score, and near anchors need few products."""
    rng = np.random.default_rng(4)
    centre = rng.standard_normal((8, 16)) * 300
    anchors = np.floor(np.repeat(centre, 40, axis=0) + rng.standard_normal((320, 16)))
    x = np.floor(rng.standard_normal((500, 16)) * 100)
    none = np.zeros(320, np.int64)
    tree, = trees_of(np.arange(320), none, none, anchors)
    low, high = np.full(320, 60_000.0), np.full(320, 90_000.0)
    want = {(int(tree.at[a]), c) for a, c in zip(*np.nonzero((tree.x @ x.T >= 60_000) & (tree.x @ x.T <= 90_000)))}
    got = set()
    for a, c, score in open_scores(tree, x, np.linalg.norm(x, axis=1), low, high, np.ones((320, 500), bool)):
        assert (score == (tree.x[a] * x[c]).sum(axis=1)).all()
        got |= set(zip(tree.at[a].tolist(), c.tolist()))
    assert got == want and want


def test_spanning_tree_is_minimal():
    x = np.random.default_rng(1).standard_normal((40, 3))
    order, parent, edge, level = spanning_tree(x)
    y = x[order]
    assert np.allclose(edge[1:], np.linalg.norm(y[1:] - y[parent[1:]], axis=1)) and (parent[1:] < np.arange(1, 40)).all()
    links, total = {i: i for i in range(40)}, 0
    root = lambda i: i if links[i] == i else root(links[i])
    for d, i, j in sorted((float(np.linalg.norm(x[i] - x[j])), i, j) for i in range(40) for j in range(i)):
        if root(i) != root(j):
            links[root(i)] = root(j)
            total += d
    assert np.isclose(edge.sum(), total) and level[0] == 0 and level[-1] == 40


def test_cases(spark):
    nan = float("nan")
    rows = [(0, 1, [1.0, 0.0]), (50, None, [1.0, 0.0]), (100, 1, None), (150, 1, [nan, 1.0]), (200, 1, [None, 1.0]), (None, 1, [1.0, 0.0]),
            (1, 1, [0.9, 0.1]), (1, 1, [0.9, 0.1]), (2, 2, [0.7, 0.1]), (3, 2, [0.7, 0.5]), (4, 3, [0.6, 0.0]), (5, 2, [0.1, 0.0]), (6, 1, [1.0]),
            (7, 1, [-1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").withColumn("score", F.lit(1)).withColumn("x", F.lit("a"))
    got = result(mine_hard_negatives(df))
    assert got == brute([r for r in rows if r[0] != 6]) and [r[3] for r in got if r[1] == 1] == [2, 3, 4]
    text = df.withColumn("label", F.concat(F.lit("l"), "label"))
    assert result(mine_hard_negatives(text)) == got
    for empty in (df.limit(0), df.where("vec_id = 0"), df.where("vec_id % 50 <> 0"), df.where("vec_id in (100, 150)")):
        assert mine_hard_negatives(empty).count() == 0
