"""Operator-level checks against plain sequential versions."""

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests import bruteforce as bf
from tests.conftest import SF01
from warband.operators.dbscan import dbscan
from warband.operators.leaders import leader_groups, leader_rounds
from warband.operators.minhash import band_buckets, signature
from warband.operators.sequences import UNKNOWN_KEYS, action_shingles, unknown_sequences
from warband.operators.similarity import avg_pairwise_cosine, medoid
from warband.plans import gold
from warband.plans.discovery import sequence_ids
from warband.registry import silver_of


def _random_points(rng, n, alphabet="abcd", length=(3, 14)):
    base = ["".join(rng.choice(alphabet) for _ in range(rng.randint(*length))) for _ in range(6)]
    out = []
    for _ in range(n):
        s = list(rng.choice(base))
        for _ in range(rng.randint(0, 2)):
            s.insert(rng.randint(0, len(s)), rng.choice(alphabet))
        out.append("".join(s))
    return out


@pytest.mark.parametrize("block,task_points,eps", [(3, 10, 0.25), (7, 10, 0.05), (7, 60, 0.6), (512, 10, 0.25), (512, 2048, 0.25), (7, 10, 1.0)])
def test_dbscan_matches_sequential(spark, block, task_points, eps):
    """Groups cut into blocks, listed in the index, or settled by one task, against the sequential algorithm."""
    rng = random.Random(block)
    texts = _random_points(rng, 60) + ["ab"]          # one text too short for any 3-gram
    ms = 4
    m = bf.matrix(texts, 3)
    want = bf.dbscan(m, eps, ms)
    grams = [bf.char_counts(t, 3) for t in texts]
    pts = spark.createDataFrame(
        [(i, 1, sorted(g), [g[k] for k in sorted(g)]) for i, g in enumerate(grams)],
        "sid long, weight long, grams array<string>, cnts array<int>")
    members = spark.createDataFrame([(0, i) for i in range(len(texts))], "g long, sid long")
    got = {r.sid: r.label for r in dbscan(members, pts, eps, ms, block_size=block, task_points=task_points).collect()}
    clusters = defaultdict(set)
    for i, lab in enumerate(want):
        if lab != -1:
            clusters[lab].add(i)
    mine = defaultdict(set)
    for sid, lab in got.items():
        mine[lab].add(sid)
    assert sorted(map(sorted, clusters.values())) == sorted(map(sorted, mine.values()))
    assert len(texts) - 1 not in got                  # zero vector is noise


def test_index_moves_few_copies(spark):
    """A large group of unlike texts: rows moved follow the number of points, not its square over the block size."""
    from warband.operators.dbscan import slots_of
    copies = {}
    for n in (2_000, 8_000):
        pts = spark.range(n).select(F.lit(0).alias("g"), F.col("id").alias("sid"), F.transform(
            F.sequence(F.lit(0), F.lit(19)), lambda k: F.when(k < 2, k.cast("bigint")).otherwise(
                F.lit(2) + F.pmod(F.xxhash64((F.col("id") / 4).cast("long"), k), F.lit(n)))).alias("grams"),
            F.array_repeat(F.lit(1), 20).alias("cnts"))
        sizes = spark.createDataFrame([(0, n)], "g long, n long")
        slots = slots_of(pts, sizes, 0.1, 32)
        assert slots.where("slot is null").count() == 0
        copies[n] = slots.agg(F.sum("nb")).first()[0]
    assert copies[8_000] < 4.5 * copies[2_000] and copies[8_000] < 8_000 * 8_000 / 32 / 8


def test_index_finds_what_blocks_find(spark):
    """Texts over many grams, so that the index is taken: the same labels as one task finds."""
    rng = random.Random(9)
    texts = []
    for c in range(60):
        base = [rng.randint(0, 400) for _ in range(25)]
        for _ in range(rng.randint(1, 7)):
            t = list(base)
            for _ in range(rng.randint(0, 4)):
                t[rng.randrange(25)] = rng.randint(0, 400)
            texts.append(t)
    rows = []
    for i, t in enumerate(texts):
        grams = sorted(set(t))
        rows.append((i, 1 + i % 2, grams, [t.count(k) for k in grams]))
    pts = spark.createDataFrame(rows, "sid long, weight long, grams array<long>, cnts array<int>")
    members = pts.select(F.lit(5).cast("long").alias("g"), "sid")
    want = {r.sid: r.label for r in dbscan(members, pts, 0.2, 4).collect()}
    got = {r.sid: r.label for r in dbscan(members, pts, 0.2, 4, block_size=8, task_points=20).collect()}
    assert got == want and len(set(want.values())) > 5


def test_dbscan_weights_count_copies(spark):
    pts = spark.createDataFrame([(0, 3, ["abc"], [1]), (1, 1, ["xyz"], [1])],
                                "sid long, weight long, grams array<string>, cnts array<int>")
    members = spark.createDataFrame([(0, 0), (0, 1)], "g long, sid long")
    got = {r.sid: r.label for r in dbscan(members, pts, 0.1, 3).collect()}
    assert got == {0: 0}                              # three identical copies make a core


def test_leaders_match_sequential_greedy(spark):
    op = gold.openings(silver_of(spark, SF01))
    rows = unknown_sequences(op)
    seqs, rows_sid = sequence_ids(rows, UNKNOWN_KEYS)
    sigs = seqs.select("sid", signature(action_shingles("actions", 2), 128).alias("sig"))
    bk = band_buckets(sigs, ["sid"], "sig", 25, 5)
    got = leader_groups(bk, seqs.select("sid", "weight")).collect()
    got_groups = defaultdict(set)
    for r in got:
        got_groups[r.leader].add(r.sid)
    # sequential walk over rows (not collapsed) in walk order
    local = sorted(rows_sid.select(*UNKNOWN_KEYS, "sid", "actions").collect(),
                   key=lambda r: tuple((x is not None, x) for x in (r.match_id, r.player_id, r.civilization, r.map_type, r.win)))
    keys = list(range(len(local)))
    bucket_of = {k: bf.buckets(bf.signature(local[k].actions, 2, 128), 25, 5) for k in keys}
    want = {local[leader].sid: {local[i].sid for i in members} for leader, members in bf.greedy_groups(keys, bucket_of)}
    assert got_groups == want


def _greedy(rows):
    """Plain walk over (sid, band, bucket) rows."""
    keys = defaultdict(list)
    for sid, band, bucket in rows:
        keys[sid].append((band, tuple(bucket)))
    taken, leaders = set(), []
    for sid in sorted(keys):
        if not taken & set(keys[sid]):
            leaders.append(sid)
            taken |= set(keys[sid])
    return leaders


def _jobs(spark, fn):
    tracker, group = spark.sparkContext.statusTracker(), f"jobs-{random.random()}"
    spark.sparkContext.setJobGroup(group, "counted")
    out = fn()
    return out, len(tracker.getJobIdsForGroup(group))


def test_leaders_of_a_long_chain_take_few_jobs(spark):
    """A chain in walk order: one walk settles it, whatever its length, and no round follows the links."""
    def leaders_of(n):
        bk = spark.range(n).select(F.col("id").alias("sid"), F.lit(0).alias("band"), F.explode(F.array(F.array("id"), F.array(F.col("id") - 1))).alias("bucket"))
        found, rounds = leader_rounds(bk)
        return sorted(r.sid for r in found.collect()), rounds
    (short, _), few = _jobs(spark, lambda: leaders_of(10))
    (long, rounds), jobs = _jobs(spark, lambda: leaders_of(10_000))
    assert short == [0, 2, 4, 6, 8] and long == list(range(0, 10_000, 2)) and rounds == 0
    assert jobs <= few + 2


@pytest.mark.parametrize("task_rows,rounds_at_most", [(10_000, 0), (120, 0), (12, 40)])
def test_leaders_over_components_and_rounds(spark, task_rows, rounds_at_most):
    """The walk in one task, over packed components, and (a component larger than a task) in rounds."""
    rng = random.Random(7)
    rows = []
    for c in range(6):                              # six components, one a chain in walk order
        ids = rng.sample(range(c * 1000, c * 1000 + 900), 30)
        if c == 0:
            rows += [(i, 0, [i]) for i in range(40)] + [(i + 1, 0, [i]) for i in range(39)]
            continue
        for i in ids:
            rows += [(i, band, [c, rng.randint(0, 8)]) for band in range(3)]
    df = spark.createDataFrame(rows, "sid long, band int, bucket array<int>")
    found, rounds = leader_rounds(df, task_rows=task_rows)
    assert sorted(r.sid for r in found.collect()) == _greedy(rows) and rounds <= rounds_at_most


def test_pairwise_cosine_linear_form(spark):
    rng = np.random.default_rng(3)
    vecs = {i: {f"g{k}": int(rng.integers(1, 5)) for k in rng.choice(8, size=4, replace=False)} for i in range(7)}
    weights = {i: int(rng.integers(1, 3)) for i in vecs}
    members = spark.createDataFrame([("c", i, w) for i, w in weights.items()], "ckey string, sid long, weight long")
    vectors = spark.createDataFrame([(i, g, c) for i, v in vecs.items() for g, c in v.items()],
                                    "sid long, gram string, cnt int")
    got = avg_pairwise_cosine(members, vectors).first().avg_ngram
    rows = [vecs[i] for i in vecs for _ in range(weights[i])]
    vocab = sorted({g for v in rows for g in v})
    m = np.array([[v.get(g, 0) for g in vocab] for v in rows], dtype=float)
    u = m / np.linalg.norm(m, axis=1)[:, None]
    sim = u @ u.T
    assert got == pytest.approx(sim[np.triu_indices(len(rows), 1)].mean(), abs=1e-12)
    rep = medoid(members, vectors).first().rep_sid
    c = m.mean(axis=0)
    d = np.round(((m - c) ** 2).sum(axis=1), 6)
    assert rep == [i for i in vecs for _ in range(weights[i])][int(np.argmin(d))]


def test_indel_kernel_equals_the_table():
    """Batches of pairs over several words, alphabets and equal second strings against the plain LCS table."""
    from warband.functions.indel import indel_ratios
    rng = random.Random(1)
    a, b = [], []
    for _ in range(300):
        letters = rng.choice(["ab", "abcdefgh ,", "aé日🙂x"])
        a.append("".join(rng.choice(letters) for _ in range(rng.choice([0, 1, 5, 63, 64, 65, 130]))))
        b.append(rng.choice(b) if b and rng.random() < 0.5 else "".join(rng.choice(letters) for _ in range(rng.choice([0, 1, 63, 64, 65, 128, 129]))))
    want = [1.0 if not x and not y else 2 * bf.lcs_dp(x, y) / (len(x) + len(y)) for x, y in zip(a, b)]
    assert (indel_ratios(a, b) == want).all()


def test_indel_of_nulls(spark):
    from warband.functions.indel import indel_similarity
    df = spark.createDataFrame([("abc", "abd"), (None, "a"), ("a", None), ("", ""), ("", "x")], "a string, b string")
    assert [r[0] for r in df.select(indel_similarity("a", "b")).collect()] == [pytest.approx(2 / 3), None, None, 1.0, 0.0]
