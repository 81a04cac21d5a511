import random

import pytest
from pyspark.sql import functions as F

from tests import bruteforce as bf
from tests.conftest import SF001, SF01
from warband.operators.minhash import band_layout, signature
from warband.operators.sequences import action_shingles, known_sequences, unknown_sequences
from warband.plans import gold
from warband.plans.discovery import known_variation, sequence_ids, unknown_clusters
from warband.registry import silver_of

TEST_PARAMS = dict(ngram_n=2, char_n=3, num_perm=128, lsh_threshold=0.5, dbscan_eps=0.05,
                   dbscan_min_samples=5, min_matches_per_player=2)


def test_signature_matches_python(spark):
    seqs = [["a", "b", "c", "d"], ["a", "b"], ["x"], ["a", "b", "c", "a", "b", "c"]]
    df = spark.createDataFrame([(s,) for s in seqs], "actions array<string>")
    got = [r.sig for r in df.select(signature(action_shingles("actions", 3), 16).alias("sig")).collect()]
    assert got == [bf.signature(s, 3, 16) for s in seqs]


def _unknown_rows(spark, sf):
    op = gold.openings(silver_of(spark, sf))
    rows = unknown_sequences(op).orderBy("match_id", "player_id", "civilization", "map_type", "win").collect()
    return op, [r.asDict() for r in rows]


@pytest.mark.parametrize("sf", [SF001, SF01])
def test_unknown_clusters_match_sequential(spark, sf):
    op, rows = _unknown_rows(spark, sf)
    bands, r = band_layout(0.5, 128)
    want = bf.unknown_clusters(rows, 2, 3, 128, bands, r, 0.05, 5, 2)
    got = unknown_clusters(op, block_size=8, **TEST_PARAMS).collect()
    got = sorted([(g.num_matches, None if g.winrate is None else round(g.winrate, 9), g.num_players,
                   round(g.avg_ngram, 6), round(g.avg_jaccard, 6), round(g.avg_levenshtein, 6)) for g in got], key=str)
    assert want, "fixture should produce clusters"
    assert got == want


def test_default_parameters_give_no_cluster_on_small_data(spark):
    op = gold.openings(silver_of(spark, SF001))
    assert unknown_clusters(op).count() == 0


def test_known_variation_matches_sequential(spark):
    op = gold.openings(silver_of(spark, SF01))
    rows = [r.asDict() for r in known_sequences(op).orderBy("strategy", "match_id", "player_id").collect()]
    want = bf.known_variation(rows, 3)
    got = sorted((r.strategy, r.num_matches, round(r.avg_jaccard, 6), round(r.avg_ngram, 6), round(r.avg_levenshtein, 6))
                 for r in known_variation(op).collect())
    assert got == want


def test_sequence_ids_follow_walk_order(spark):
    op = gold.openings(silver_of(spark, SF001))
    rows = unknown_sequences(op)
    seqs, rows_sid = sequence_ids(rows, ["match_id", "player_id", "civilization", "map_type", "win"])
    first = (rows_sid.groupBy("sid").agg(F.min(F.struct("match_id", "player_id", "civilization", "map_type", "win")).alias("o"))
             .orderBy("sid").collect())
    orders = [tuple(r.o) for r in first]
    assert orders == sorted(orders, key=lambda t: tuple((x is not None, x) for x in t))
    assert seqs.agg(F.sum("weight")).first()[0] == rows.count()


def test_clusters_unchanged_by_partitioning(spark):
    op = gold.openings(silver_of(spark, SF01))
    a = sorted(tuple(r) for r in unknown_clusters(op, **TEST_PARAMS).collect())
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        shuffled = op.repartition(5, F.rand(11))
        b = sorted(tuple(r) for r in unknown_clusters(shuffled, block_size=4, **TEST_PARAMS).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    key = lambda t: (t[0], t[1], t[2], t[3], round(t[4], 9), round(t[5], 9), round(t[6], 9))
    assert [key(t) for t in a] == [key(t) for t in b]
