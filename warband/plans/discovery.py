"""Build-order discovery (U16–U18): how tight named strategies are, and which unnamed
openings recur.

Identical sequences are collapsed first: each distinct action sequence gets an id in walk
order (``sid``) and a weight (its number of rows). Signatures, buckets, leader rounds and
DBSCAN run on distinct sequences; counts use the weights, which is exact because identical
sequences always share buckets, groups and neighbourhoods.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from warband.operators.dbscan import dbscan
from warband.operators.leaders import leader_groups
from warband.operators.minhash import band_buckets, band_layout, signature
from warband.operators.sequences import (UNKNOWN_KEYS, action_shingles, char_ngrams, known_sequences,
                                         unknown_sequences)
from warband.operators.similarity import avg_against_representative, avg_jaccard, avg_pairwise_cosine, medoid
from warband.session import checkpoint_dir, materialize
from warband.sources.publish import publish_path, publish_table


def sequence_ids(rows: DataFrame, order_cols: list[str]) -> tuple[DataFrame, DataFrame]:
    """Distinct sequences ``(sid, actions, build_order_seq, weight, first_row)`` and rows with their sid.

    ``sid`` increases with the first row's ``order_cols`` (a distributed range sort, then
    per-partition ids), and the table is written to the checkpoint folder so the ids survive
    recomputation.
    """
    checkpoint_dir(rows.sparkSession)
    # The rows (one per match-player) are used twice below; writing them once keeps the whole
    # upstream (event shuffle, opening ranks) from running twice. The distinct table is
    # written too, because the range sort samples its input before sorting it.
    rows = materialize(rows, "sequence-rows")
    distinct = materialize(rows.groupBy("actions")
                           .agg(F.min(F.struct(*order_cols)).alias("_o"), F.count("*").alias("weight")),
                           "distinct-sequences")
    d = (distinct.orderBy("_o")
         .withColumn("sid", F.monotonically_increasing_id())
         .select("sid", "actions", F.array_join("actions", ",").alias("build_order_seq"), "weight",
                 F.col("_o").alias("first_row")))
    d = materialize(d, "sequences")
    return d, rows.join(d.select("actions", "sid"), "actions")


def gram_vectors(seqs: DataFrame, char_n: int = 3) -> DataFrame:
    """(sid, gram, cnt) char n-gram counts of each distinct sequence text."""
    return char_ngrams(seqs, ["sid"], "build_order_seq", char_n)


def known_members(openings: DataFrame):
    """Known-strategy rows collapsed in one pass.

    Returns ``seqs`` (sid, actions, build_order_seq), ``members`` (ckey = strategy, sid,
    weight = rows with that exact sequence) and ``reps`` (ckey, rep_sid, rep_actions, rep_seq):
    the most common sequence per strategy, ties → first by (match, player). No walk order is
    needed here, so ids come without a sort.
    """
    per = materialize(known_sequences(openings).groupBy("strategy", "actions")
                      .agg(F.count("*").alias("weight"), F.min(F.struct("match_id", "player_id")).alias("_first")),
                      "known-members")
    seqs = materialize(per.select("actions").distinct()
                       .withColumn("sid", F.monotonically_increasing_id())
                       .select("sid", "actions", F.array_join("actions", ",").alias("build_order_seq")),
                       "known-sequences")
    members = per.join(seqs.select("actions", "sid"), "actions").select(
        F.col("strategy").alias("ckey"), "sid", "weight", "_first")
    best = members.groupBy("ckey").agg(F.min(F.struct((-F.col("weight")).alias("_nw"), "_first", "sid")).alias("_b"))
    reps = best.select("ckey", F.col("_b.sid").alias("rep_sid")).join(
        seqs.select(F.col("sid").alias("rep_sid"), F.col("actions").alias("rep_actions"),
                    F.col("build_order_seq").alias("rep_seq")), "rep_sid")
    return seqs, members.drop("_first"), reps


def known_variation(openings: DataFrame, char_n: int = 3) -> DataFrame:
    """U16: per named strategy, matches and mean similarity (%) of its build orders.

    avg_ngram: mean pairwise cosine of char n-gram counts; avg_jaccard / avg_levenshtein:
    mean action-set Jaccard / indel similarity against the most common build order
    (ties → first by match, player).
    """
    seqs, members, reps = known_members(openings)
    vectors = materialize(gram_vectors(seqs, char_n), "known-vectors")   # read by several joins
    sizes = members.groupBy("ckey").agg(F.sum("weight").alias("num_matches"))
    out = (sizes.join(avg_against_representative(members, seqs.select("sid", "actions", "build_order_seq"), reps), "ckey")
           .join(avg_pairwise_cosine(members, vectors), "ckey"))
    return out.select(F.col("ckey").alias("strategy"), "num_matches",
                      (F.col("avg_jaccard") * 100).alias("avg_jaccard"),
                      (F.col("avg_ngram") * 100).alias("avg_ngram"),
                      (F.col("avg_levenshtein") * 100).alias("avg_levenshtein"))


def dbscan_points(seqs: DataFrame, vectors: DataFrame) -> DataFrame:
    """(sid, weight, grams, cnts): each distinct sequence's n-gram counts as parallel arrays of gram numbers and
    counts (bounded by the text length), the input rows of the DBSCAN block kernels."""
    number = materialize(vectors.select("gram").distinct().withColumn("no", F.monotonically_increasing_id()), "gram-numbers")
    points = (vectors.join(number, "gram").groupBy("sid").agg(F.array_sort(F.collect_list(F.struct("no", "cnt"))).alias("_v"))
              .select("sid", F.col("_v.no").alias("grams"), F.col("_v.cnt").alias("cnts")))
    return materialize(seqs.select("sid", "weight").join(points, "sid", "left").select(
        "sid", "weight", F.coalesce("grams", F.array().cast("array<bigint>")).alias("grams"),
        F.coalesce("cnts", F.array().cast("array<int>")).alias("cnts")), "points")


def candidate_groups(seqs: DataFrame, ngram_n: int = 3, num_perm: int = 128,
                     lsh_threshold: float = 0.5) -> DataFrame:
    """(g, sid) memberships of the greedy LSH candidate groups (g = leader sid)."""
    sigs = seqs.select("sid", signature(action_shingles("actions", ngram_n), num_perm).alias("sig"))
    bands, rows = band_layout(lsh_threshold, num_perm)
    buckets = materialize(band_buckets(sigs, ["sid"], "sig", bands, rows), "buckets")
    groups = leader_groups(buckets, seqs.select("sid", "weight")).select(F.col("leader").alias("g"), "sid")
    return materialize(groups, "candidate-groups")


def cluster_statistics(labels: DataFrame, seqs: DataFrame, rows_sid: DataFrame, vectors: DataFrame,
                       min_samples: int, min_matches_per_player: int, with_indel: bool = True) -> DataFrame:
    """U10–U14 per DBSCAN cluster ``ckey = (g, label)``.

    Keeps clusters with at least ``min_samples`` rows and one player using them at least
    ``min_matches_per_player`` times; returns num_matches, winrate (NULL wins skipped),
    num_players, the medoid ``rep_sid``, avg_ngram, avg_jaccard and (``with_indel``)
    avg_levenshtein, all 0–1.
    """
    labels = labels.select(F.struct("g", "label").alias("ckey"), "sid")
    # Row-level statistics in two partial aggregations: per (cluster, player), then per cluster.
    per_player = (labels.join(rows_sid.select("sid", "player_id", "win"), "sid")
                  .groupBy("ckey", "player_id")
                  .agg(F.count("*").alias("_n"), F.sum("win").alias("_ws"), F.count("win").alias("_wc")))
    per_cluster = per_player.groupBy("ckey").agg(
        F.sum("_n").alias("num_matches"), F.max("_n").alias("_top"), F.count("*").alias("num_players"),
        F.try_divide(F.sum("_ws").cast("double"), F.sum("_wc")).alias("winrate"))
    kept = materialize(per_cluster.where((F.col("num_matches") >= min_samples)
                                         & (F.col("_top") >= min_matches_per_player)).drop("_top"), "kept-clusters")
    members = materialize(labels.join(seqs.select("sid", "weight"), "sid").join(kept.select("ckey"), "ckey"), "cluster-members")

    reps = medoid(members, vectors).join(
        seqs.select(F.col("sid").alias("rep_sid"), F.col("actions").alias("rep_actions"),
                    F.col("build_order_seq").alias("rep_seq")), "rep_sid")
    reps = materialize(reps, "representatives")
    seq_cols = seqs.select("sid", "actions", "build_order_seq")
    sims = (avg_against_representative(members, seq_cols, reps) if with_indel
            else avg_jaccard(members, seq_cols, reps))
    return (kept.join(reps.select("ckey", "rep_sid"), "ckey")
            .join(avg_pairwise_cosine(members, vectors), "ckey").join(sims, "ckey"))


def unknown_cluster_rows(openings: DataFrame, ngram_n: int = 3, num_perm: int = 128,
                     lsh_threshold: float = 0.5, dbscan_eps: float = 0.3, dbscan_min_samples: int = 50,
                     min_matches_per_player: int = 2, char_n: int | None = None,
                     block_size: int = 512) -> DataFrame:
    """Recurring unnamed openings, with the natural keys they are known by.

    MinHash-LSH candidate groups → DBSCAN per group on char n-gram cosine distance →
    clusters with at least ``dbscan_min_samples`` rows and one player using them at least
    ``min_matches_per_player`` times → per-cluster size, win rate (NULL wins skipped),
    players and cohesion (pairwise cosine, Jaccard and indel similarity against the medoid,
    all 0–1). ``char_n`` defaults to ``ngram_n`` as in the reference call.
    """
    char_n = ngram_n if char_n is None else char_n
    rows = unknown_sequences(openings)
    seqs, rows_sid = sequence_ids(rows, UNKNOWN_KEYS)
    groups = candidate_groups(seqs, ngram_n, num_perm, lsh_threshold)
    vectors = materialize(gram_vectors(seqs, char_n), "vectors")   # used by DBSCAN and the statistics
    labels = dbscan(groups, dbscan_points(seqs, vectors), dbscan_eps, dbscan_min_samples, block_size)
    labels = materialize(labels, "clusters")
    out = cluster_statistics(labels, seqs, rows_sid, vectors, dbscan_min_samples, min_matches_per_player)
    first = seqs.select("sid", "first_row")
    out = (out.join(first.select(F.col("sid").alias("_g"), F.col("first_row").alias("group_first")), F.col("ckey.g") == F.col("_g"))
           .join(first.select(F.col("sid").alias("_l"), F.col("first_row").alias("cluster_first")), F.col("ckey.label") == F.col("_l")))
    return out.select("group_first", "cluster_first", "num_matches", "winrate", "num_players", "avg_ngram", "avg_jaccard",
                      "avg_levenshtein")


def unknown_clusters(openings: DataFrame, **params) -> DataFrame:
    """U17 as published: ``unknown_cluster_rows`` under one id.

    The id hashes the first rows of the group's leader and of the first core, so it does not depend on
    how the internal sequence ids were assigned.
    """
    return unknown_cluster_rows(openings, **params).select(
        F.xxhash64("group_first", "cluster_first").alias("cluster_id"), "num_matches", "winrate", "num_players", "avg_ngram",
        "avg_jaccard", "avg_levenshtein")


def publish_clusters(spark: SparkSession, clusters: DataFrame, table: str = "gold.clustered_unknown_strategies",
                     path: str | None = None) -> bool:
    """Replace the cluster table only when there is at least one cluster.

    With ``path`` the clusters are written to that folder instead of a catalog table. The clusters are
    computed once, into the scratch folder, before they are tested and published.
    """
    clusters = materialize(clusters, "clusters-to-publish")
    if clusters.isEmpty():
        return False
    if path:
        publish_path(clusters, path)
    else:
        publish_table(clusters, table)
    return True
