"""Registered queries (Spark) and their DuckDB oracle SQL, keyed alike.

Every query reads the driver's tables through the events adapter, so its work grows with
``events``. Filter values are the dashboard defaults (elo 2500–3100, every civilization)
except where a key says otherwise.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from warband import oracle as O
from warband.functions.indel import indel_similarity
from warband.operators.dbscan import dbscan
from warband.operators.minhash import band_buckets, band_layout, signature
from warband.operators.sequences import (UNKNOWN_KEYS, action_shingles, char_ngrams, known_sequences,
                                         modal_sequence, unknown_sequences)
from warband.operators.similarity import avg_jaccard, avg_pairwise_cosine
from warband.plans import analyst, discovery, gold
from warband.plans.silver import events_clean, store_silver
from warband.session import checkpoint_dir, materialize
from warband.sources.adapter import ACTIVITY_OF_EVENT_TYPE, load_bronze, traces_from_bronze
from warband.sources.xes import events_of_fragments

ELO_LO, ELO_HI = 2500, 3100
OPENING_N = 10            # adapter matches have 9–40 actions; 10 makes the cut bite
APM_WIDE_WINDOW = 172_800  # two days: most adapter rows fall inside
CIV_PICK = ["NATION_1", "NATION_2", "NATION_3", "NATION_4", "NATION_5"]
CIV_LIKE_PICK = ["NATION_1", "NATION_2"]  # substring test: NATION_1 also hits NATION_1x
AGE_ACTIVITIES = sorted(a for a in ACTIVITY_OF_EVENT_TYPE.values() if a.endswith(" Age"))
SHINGLE_N, NUM_PERM, LSH_THRESHOLD, CHAR_N = 3, 128, 0.5, 3
# Discovery parameters that give clusters on the adapter data (the defaults give none).
DISCOVERY_TEST = dict(ngram_n=2, char_n=3, dbscan_eps=0.05, dbscan_min_samples=5, min_matches_per_player=2)
# The reference's actual run: defaults with three matches per player.
DISCOVERY_RUN = dict(ngram_n=3, min_matches_per_player=3)


def silver_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silver plan over a folder's tables."""
    return events_clean(load_bronze(spark, sf_dir))


def _q_bronze_from_xes(spark, sf_dir):
    """The events log written as XES traces and read back through the XES parser."""
    return events_of_fragments(traces_from_bronze(load_bronze(spark, sf_dir))).drop("attrs").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def _gold(name: str, **kw) -> Callable[[SparkSession, str], DataFrame]:
    fn = getattr(gold, name)
    return lambda spark, sf_dir: fn(silver_of(spark, sf_dir), **kw)


def _q_players_by_elo(spark, sf_dir):
    return analyst.players_by_elo(gold.player_summary(silver_of(spark, sf_dir)), ELO_LO, ELO_HI)


def _q_apm_by_player(spark, sf_dir):
    s = silver_of(spark, sf_dir)
    return analyst.apm_by_player(gold.apm(s), s, ELO_LO, ELO_HI)


def _q_age_matrix(spark, sf_dir):
    return analyst.age_matrix(gold.age_timings(silver_of(spark, sf_dir)))


def _q_opening_sequences(spark, sf_dir):
    return analyst.opening_sequences(gold.openings(silver_of(spark, sf_dir)), OPENING_N, ELO_LO, ELO_HI)


def _q_action_step_counts(spark, sf_dir):
    return analyst.action_step_counts(gold.openings(silver_of(spark, sf_dir)), OPENING_N, ELO_LO, ELO_HI)


def _q_action_step_matrix(spark, sf_dir):
    return analyst.action_step_matrix(gold.openings(silver_of(spark, sf_dir)), OPENING_N, ELO_LO, ELO_HI)


def _q_civ_winrates(spark, sf_dir):
    return analyst.civ_winrates(gold.winrate_civ(silver_of(spark, sf_dir)), CIV_PICK)


def _q_strategy_winrates(spark, sf_dir):
    return analyst.strategy_winrates(gold.winrate_strat(silver_of(spark, sf_dir)), CIV_LIKE_PICK)


def _q_civilizations(spark, sf_dir):
    return analyst.civilizations(silver_of(spark, sf_dir))


def openings_of(spark: SparkSession, sf_dir: str, top_n: int = 100) -> DataFrame:
    return gold.openings(silver_of(spark, sf_dir), top_n=top_n)


def _unknown(spark, sf_dir):
    return unknown_sequences(openings_of(spark, sf_dir))


def _q_known_sequences(spark, sf_dir):
    return known_sequences(openings_of(spark, sf_dir)).select("strategy", "match_id", "player_id", "build_order_seq")


def _q_unknown_sequences(spark, sf_dir):
    return _unknown(spark, sf_dir).select(*UNKNOWN_KEYS, "build_order_seq")


def _q_action_shingles(spark, sf_dir):
    return (_unknown(spark, sf_dir)
            .select(*UNKNOWN_KEYS, F.posexplode(action_shingles("actions", SHINGLE_N)).alias("pos", "shingle"))
            .withColumn("pos", F.col("pos") + 1))


def _signatures(spark, sf_dir):
    return _unknown(spark, sf_dir).select(
        *UNKNOWN_KEYS, signature(action_shingles("actions", SHINGLE_N), NUM_PERM).alias("sig"))


def _q_minhash_signatures(spark, sf_dir):
    return _signatures(spark, sf_dir).select(*UNKNOWN_KEYS, F.posexplode("sig").alias("perm", "minhash"))


def _q_lsh_buckets(spark, sf_dir):
    bands, rows = band_layout(LSH_THRESHOLD, NUM_PERM)
    return (band_buckets(_signatures(spark, sf_dir), UNKNOWN_KEYS, "sig", bands, rows)
            .select(*UNKNOWN_KEYS, "band",
                    F.array_join(F.transform("bucket", lambda x: x.cast("string")), "-").alias("bucket")))


def _q_leader_groups(spark, sf_dir):
    seqs, rows_sid = discovery.sequence_ids(_unknown(spark, sf_dir), UNKNOWN_KEYS)
    groups = discovery.candidate_groups(seqs, SHINGLE_N, NUM_PERM, LSH_THRESHOLD)
    first = rows_sid.groupBy("sid").agg(F.min(F.struct(*UNKNOWN_KEYS)).alias("_o"))
    lead = first.select(F.col("sid").alias("g"), F.col("_o.match_id").alias("group_match_id"),
                        F.col("_o.player_id").alias("group_player_id"))
    return (groups.join(lead, "g").join(rows_sid.select("sid", *UNKNOWN_KEYS), "sid")
            .select("group_match_id", "group_player_id", *UNKNOWN_KEYS))


def _test_clusters(spark, sf_dir):
    """Collapsed sequences, their rows, n-gram vectors and DBSCAN labels (test parameters)."""
    p = DISCOVERY_TEST
    seqs, rows_sid = discovery.sequence_ids(_unknown(spark, sf_dir), UNKNOWN_KEYS)
    groups = discovery.candidate_groups(seqs, p["ngram_n"], NUM_PERM, LSH_THRESHOLD)
    vectors = materialize(discovery.gram_vectors(seqs, p["char_n"]), "vectors")
    labels = materialize(dbscan(groups, discovery.dbscan_points(seqs, vectors), p["dbscan_eps"],
                                p["dbscan_min_samples"]), "clusters")
    first = rows_sid.groupBy("sid").agg(F.min(F.struct("match_id", "player_id")).alias("_o"))
    return seqs, rows_sid, vectors, labels, first


def _first_keys(first, col: str, prefix: str):
    return first.select(F.col("sid").alias(col), F.col("_o.match_id").alias(f"{prefix}_match_id"),
                        F.col("_o.player_id").alias(f"{prefix}_player_id"))


def _q_dbscan_clusters(spark, sf_dir):
    """DBSCAN cluster membership per row, before the size and repeated-player filter."""
    _, rows_sid, _, labels, first = _test_clusters(spark, sf_dir)
    return (labels.join(_first_keys(first, "g", "group"), "g").join(_first_keys(first, "label", "cluster"), "label")
            .join(rows_sid.select("sid", *UNKNOWN_KEYS), "sid")
            .select("group_match_id", "group_player_id", "cluster_match_id", "cluster_player_id", *UNKNOWN_KEYS))


def _q_cluster_stats(spark, sf_dir):
    """U10–U13 per kept cluster: size, win rate, players, medoid, pairwise cosine, Jaccard."""
    p = DISCOVERY_TEST
    seqs, rows_sid, vectors, labels, first = _test_clusters(spark, sf_dir)
    st = discovery.cluster_statistics(labels, seqs, rows_sid, vectors, p["dbscan_min_samples"],
                                      p["min_matches_per_player"], with_indel=False)
    st = st.select(F.col("ckey.g").alias("g"), F.col("ckey.label").alias("label"), "rep_sid", "num_matches",
                   "winrate", "num_players", F.round("avg_ngram", 6).alias("avg_ngram"),
                   F.round("avg_jaccard", 6).alias("avg_jaccard"))
    return (st.join(_first_keys(first, "g", "group"), "g").join(_first_keys(first, "label", "cluster"), "label")
            .join(_first_keys(first, "rep_sid", "rep"), "rep_sid")
            .select("group_match_id", "group_player_id", "cluster_match_id", "cluster_player_id", "rep_match_id",
                    "rep_player_id", "num_matches", "winrate", "num_players", "avg_ngram", "avg_jaccard"))


def _q_char_ngrams(spark, sf_dir):
    return char_ngrams(_unknown(spark, sf_dir), UNKNOWN_KEYS, "build_order_seq", CHAR_N)


def _q_pairwise_cohesion(spark, sf_dir):
    seqs, members, _ = discovery.known_members(openings_of(spark, sf_dir))
    return (avg_pairwise_cosine(members, materialize(discovery.gram_vectors(seqs, CHAR_N), "known-vectors"))
            .select(F.col("ckey").alias("strategy"), F.round("avg_ngram", 6).alias("avg_ngram")))


def _q_jaccard_to_modal(spark, sf_dir):
    seqs, members, reps = discovery.known_members(openings_of(spark, sf_dir))
    return (avg_jaccard(members, seqs.select("sid", "actions"), reps)
            .select(F.col("ckey").alias("strategy"), F.round("avg_jaccard", 6).alias("avg_jaccard")))


def _q_modal_sequences(spark, sf_dir):
    return modal_sequence(known_sequences(openings_of(spark, sf_dir)), "strategy", ["match_id", "player_id"])


def _q_indel_to_modal(spark, sf_dir):
    """Indel similarity of every distinct named build order to its strategy's most common one."""
    seqs, members, reps = discovery.known_members(openings_of(spark, sf_dir))
    rows = members.join(seqs.select("sid", "build_order_seq"), "sid").join(reps.select("ckey", "rep_seq"), "ckey")
    return rows.select(F.col("ckey").alias("strategy"), "build_order_seq",
                       F.round(indel_similarity(F.col("build_order_seq"), F.col("rep_seq")), 6).alias("indel"))


def _q_known_variation(spark, sf_dir):
    out = discovery.known_variation(openings_of(spark, sf_dir), CHAR_N)
    return out.select("strategy", "num_matches", *[F.round(c, 4).alias(c) for c in ("avg_jaccard", "avg_ngram", "avg_levenshtein")])


def _cluster_rows(openings, **params):
    """Clusters under the first rows of their group and first core: a 64-bit id cannot be written in SQL."""
    out = discovery.unknown_cluster_rows(openings, **params)
    return out.select(F.col("group_first.match_id").alias("group_match_id"), F.col("group_first.player_id").alias("group_player_id"),
                      F.col("cluster_first.match_id").alias("cluster_match_id"), F.col("cluster_first.player_id").alias("cluster_player_id"),
                      "num_matches", "winrate", "num_players",
                      *[F.round(c, 6).alias(c) for c in ("avg_ngram", "avg_jaccard", "avg_levenshtein")])


def _q_unknown_clusters(spark, sf_dir):
    return _cluster_rows(openings_of(spark, sf_dir), **DISCOVERY_TEST)


def _q_unknown_clusters_default(spark, sf_dir):
    return _cluster_rows(openings_of(spark, sf_dir), **DISCOVERY_RUN)


def _repeated_openings(spark, sf_dir):
    """Openings whose actions follow their rank: matches of a player all open alike, in one of two ways."""
    names = F.array(*[F.lit(a) for a in ACTIVITY_OF_EVENT_TYPE.values()])
    step = ((F.col("action_rank") - 1) % len(ACTIVITY_OF_EVENT_TYPE)).cast("int")
    turned = F.expr("cast(substr(player_id, 2) as bigint) div 4 % 2") == 1
    return openings_of(spark, sf_dir).withColumn("activity", F.element_at(names, F.when(turned, -1 - step).otherwise(1 + step)))


def _q_unknown_clusters_repeated(spark, sf_dir):
    """U17 with the reference's parameters where unnamed openings do recur."""
    return _cluster_rows(_repeated_openings(spark, sf_dir), **DISCOVERY_RUN)


def _scratch(spark, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _q_silver_stored(spark, sf_dir):
    """Silver as the bucketed table gives it back."""
    table = f"silver_stored_{uuid.uuid4().hex}"
    store_silver(silver_of(spark, sf_dir), table)
    return spark.table(table)


def _q_gold_published(spark, sf_dir):
    """The player summary as the published gold tables hold it, after an older version was replaced."""
    path = _scratch(spark, "gold")
    silver = materialize(silver_of(spark, sf_dir), "silver")
    gold.write_gold(silver.where("player_id < 'p5'"), path)
    gold.write_gold(silver, path)
    return spark.read.parquet(f"{path}/player_summary")


def _q_clusters_published(spark, sf_dir):
    """The clusters as published; the empty result that follows leaves them as they were."""
    path = _scratch(spark, "clusters")
    found = _q_unknown_clusters_repeated(spark, sf_dir)
    stored = discovery.publish_clusters(spark, found, path=path)
    discovery.publish_clusters(spark, found.limit(0), path=path)
    return spark.read.parquet(path) if stored else found.limit(0)


def _q_cluster_summary(spark, sf_dir):
    return analyst.cluster_summary(_q_unknown_clusters(spark, sf_dir))


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q: dict[str, Callable[[SparkSession, str], DataFrame]] = {
        "bronze_from_xes": _q_bronze_from_xes,
        "events_clean": silver_of,
        "player_match_results": _gold("player_match_results"),
        "player_strategy_usage": _gold("player_strategy_usage"),
        "player_summary": _gold("player_summary"),
        "apm": _gold("apm"),
        "apm_window_2d": _gold("apm", window_s=APM_WIDE_WINDOW),
        "age_timings": _gold("age_timings"),
        "openings": _gold("openings"),
        "openings_top10": _gold("openings", top_n=OPENING_N),
        "winrate_civ": _gold("winrate_civ"),
        "winrate_strat": _gold("winrate_strat"),
        "players_by_elo": _q_players_by_elo,
        "apm_by_player": _q_apm_by_player,
        "age_matrix": _q_age_matrix,
        "opening_sequences": _q_opening_sequences,
        "action_step_counts": _q_action_step_counts,
        "action_step_matrix": _q_action_step_matrix,
        "civ_winrates": _q_civ_winrates,
        "strategy_winrates": _q_strategy_winrates,
        "civilizations": _q_civilizations,
        "known_sequences": _q_known_sequences,
        "unknown_sequences": _q_unknown_sequences,
        "action_shingles": _q_action_shingles,
        "minhash_signatures": _q_minhash_signatures,
        "lsh_buckets": _q_lsh_buckets,
        "leader_groups": _q_leader_groups,
        "dbscan_clusters": _q_dbscan_clusters,
        "cluster_stats": _q_cluster_stats,
        "char_ngrams": _q_char_ngrams,
        "pairwise_cohesion": _q_pairwise_cohesion,
        "jaccard_to_modal": _q_jaccard_to_modal,
        "modal_sequences": _q_modal_sequences,
        "indel_to_modal": _q_indel_to_modal,
        "known_variation": _q_known_variation,
        "unknown_clusters": _q_unknown_clusters,
        "unknown_clusters_default": _q_unknown_clusters_default,
        "unknown_clusters_repeated": _q_unknown_clusters_repeated,
        "silver_stored": _q_silver_stored,
        "gold_published": _q_gold_published,
        "clusters_published": _q_clusters_published,
        "cluster_summary": _q_cluster_summary,
    }
    return q


def oracle_queries() -> dict[str, str]:
    base = O.BASE
    n = OPENING_N
    steps = ", ".join(f'COUNT(*) FILTER (WHERE action_rank = {i}) AS "{i}"' for i in range(1, n + 1))
    like = " OR ".join(f"contains(civilizations, '{c}')" for c in CIV_LIKE_PICK)
    out_base = {
        "bronze_from_xes": O.with_(O.BRONZE) + "SELECT * FROM bronze",
        "events_clean": O.with_(*base) + "SELECT * FROM silver",
        "player_match_results": O.with_(*base, O.PMR) + "SELECT * FROM pmr",
        "player_strategy_usage": O.with_(*base, O.USAGE) + "SELECT * FROM usage",
        "player_summary": O.with_(*base, O.PMR, O.USAGE, O.SUMMARY) + "SELECT * FROM summary",
        "apm": O.with_(*base, O.apm_cte(600)) + "SELECT * FROM apm",
        "apm_window_2d": O.with_(*base, O.apm_cte(APM_WIDE_WINDOW)) + "SELECT * FROM apm",
        "age_timings": O.with_(*base, O.AGE) + "SELECT * FROM age",
        "openings": O.with_(*base, O.PMR, O.openings_cte(100)) + "SELECT * FROM openings",
        "openings_top10": O.with_(*base, O.PMR, O.openings_cte(n)) + "SELECT * FROM openings",
        "winrate_civ": O.with_(*base, O.WINRATE_CIV) + "SELECT * FROM winrate_civ",
        "winrate_strat": O.with_(*base, O.WINRATE_STRAT) + "SELECT * FROM winrate_strat",
        "players_by_elo": O.with_(*base, O.PMR, O.USAGE, O.SUMMARY)
        + f"SELECT {O.short('player_id', 8)} AS player_id, max_elo, total_matches, total_wins, "
          f"total_loses, winrate, used_strategies FROM summary WHERE max_elo BETWEEN {ELO_LO} AND {ELO_HI}",
        "apm_by_player": O.with_(*base, O.apm_cte(600))
        + "SELECT elo, " + O.short("player_id", 8) + " AS player_id, " + O.short("match_id", 10)
        + " AS match_id, apm, civilization FROM ("
          "SELECT DISTINCT e.elo, a.player_id, a.match_id, a.apm, e.civilization FROM apm a "
          "JOIN (SELECT DISTINCT elo, player_id, match_id, civilization FROM silver) e USING (player_id, match_id) "
          f"WHERE e.elo BETWEEN {ELO_LO} AND {ELO_HI} AND {O.civ_in('e.civilization', None)})",
        "age_matrix": O.with_(*base, O.AGE)
        + "SELECT civilization, "
        + ", ".join(f"MAX(avg_time_mins) FILTER (WHERE activity = '{a}') AS \"{a}\"" for a in AGE_ACTIVITIES)
        + " FROM age WHERE civilization IS NOT NULL GROUP BY civilization",
        "opening_sequences": O.with_(*base, O.PMR, O.openings_cte(100))
        + "SELECT elo, " + O.short("player_id", 8) + " AS player_id, " + O.short("match_id", 10)
        + " AS match_id, win = 1 AS win, civilization, civilization_category, map_type, strategy, "
          "STRING_AGG(activity, ' → ' ORDER BY action_rank) AS activity FROM openings "
          f"WHERE {O.opening_filter(n, ELO_LO, ELO_HI, None)} AND elo IS NOT NULL AND player_id IS NOT NULL "
          "AND match_id IS NOT NULL AND win IS NOT NULL AND civilization_category IS NOT NULL "
          "AND map_type IS NOT NULL AND strategy IS NOT NULL "
          "GROUP BY elo, player_id, match_id, win, civilization, civilization_category, map_type, strategy",
        "action_step_counts": O.with_(*base, O.PMR, O.openings_cte(100))
        + "SELECT activity, action_rank, COUNT(*) AS n_actions FROM openings "
          f"WHERE {O.opening_filter(n, ELO_LO, ELO_HI, None)} GROUP BY activity, action_rank",
        "action_step_matrix": O.with_(*base, O.PMR, O.openings_cte(100))
        + f"SELECT activity, {steps} FROM openings "
          f"WHERE {O.opening_filter(n, ELO_LO, ELO_HI, None)} GROUP BY activity",
        "civ_winrates": O.with_(*base, O.WINRATE_CIV)
        + f"SELECT civilization, total_games, winrate, playrate FROM winrate_civ WHERE {O.civ_in('civilization', CIV_PICK)}",
        "strategy_winrates": O.with_(*base, O.WINRATE_STRAT)
        + f"SELECT strategy, total_games, winrate, civilizations FROM winrate_strat WHERE {like}",
        "civilizations": O.with_(*base) + "SELECT DISTINCT civilization FROM silver WHERE civilization IS NOT NULL",
    }
    op = (*base, O.PMR, O.openings_cte(100))
    bands, rows = band_layout(LSH_THRESHOLD, NUM_PERM)
    uk = O.UKEYS
    disc = {
        "known_sequences": O.with_(*op, O.KNOWN_ROWS) + "SELECT strategy, match_id, player_id, build_order_seq FROM kn",
        "unknown_sequences": O.with_(*op, O.UNKNOWN_ROWS) + f"SELECT {uk}, build_order_seq FROM unk",
        "action_shingles": O.with_(*op, O.UNKNOWN_ROWS, O.shingles_cte(SHINGLE_N)) + "SELECT * FROM sh",
        "minhash_signatures": O.with_(*op, O.UNKNOWN_ROWS, O.shingles_cte(SHINGLE_N), O.signature_cte(SHINGLE_N, NUM_PERM))
        + "SELECT * FROM sig",
        "lsh_buckets": O.with_(*op, O.UNKNOWN_ROWS, O.shingles_cte(SHINGLE_N), O.signature_cte(SHINGLE_N, NUM_PERM))
        + f"SELECT {uk}, CAST(perm // {rows} AS INTEGER) AS band, "
          f"STRING_AGG(CAST(minhash AS VARCHAR), '-' ORDER BY perm) AS bucket FROM sig "
          f"WHERE perm < {bands * rows} GROUP BY {uk}, perm // {rows}",
        "char_ngrams": O.with_(*op, O.UNKNOWN_ROWS, O.grams_cte("unk_grams", "unk", uk, CHAR_N)) + "SELECT * FROM unk_grams",
        "pairwise_cohesion": O.with_(*op, O.KNOWN_ROWS, O.grams_cte("kn_grams", "kn", "strategy, match_id, player_id", CHAR_N),
                                     O.PAIRWISE_KNOWN)
        + "SELECT c.strategy, ROUND(CASE WHEN c.n > 1 THEN COALESCE(s.s, 0) / (c.n * (c.n - 1) / 2.0) ELSE 1.0 END, 6) "
          "AS avg_ngram FROM kn_count c LEFT JOIN kn_cos s USING (strategy)",
        "jaccard_to_modal": O.with_(*op, O.KNOWN_ROWS)
        + "SELECT k.strategy, ROUND(AVG(CAST(len(list_intersect(list_distinct(k.acts), list_distinct(m.rep_acts))) AS DOUBLE)"
          " / len(list_distinct(list_concat(k.acts, m.rep_acts)))), 6) AS avg_jaccard "
          "FROM kn k JOIN modal m USING (strategy) GROUP BY k.strategy",
        "modal_sequences": O.with_(*op, O.KNOWN_ROWS) + "SELECT strategy, rep_seq FROM modal",
        "dbscan_clusters": O.with_(*op, O.UNKNOWN_ROWS, O.shingles_cte(DISCOVERY_TEST["ngram_n"]),
                                   O.signature_cte(DISCOVERY_TEST["ngram_n"], NUM_PERM), O.leader_groups_sql(bands, rows),
                                   O.dbscan_sql(DISCOVERY_TEST["dbscan_eps"], DISCOVERY_TEST["dbscan_min_samples"],
                                                DISCOVERY_TEST["char_n"])).replace("WITH ", "WITH RECURSIVE ", 1)
        + "SELECT g.match_id AS group_match_id, g.player_id AS group_player_id, l.match_id AS cluster_match_id, "
          "l.player_id AS cluster_player_id, r.match_id, r.player_id, r.civilization, r.map_type, r.win "
          "FROM clustered c JOIN walk g ON g.rk = c.leader JOIN walk l ON l.rk = c.label JOIN walk r ON r.rk = c.rk",
        "cluster_stats": O.with_(*op, O.UNKNOWN_ROWS, O.shingles_cte(DISCOVERY_TEST["ngram_n"]),
                                 O.signature_cte(DISCOVERY_TEST["ngram_n"], NUM_PERM), O.leader_groups_sql(bands, rows),
                                 O.dbscan_sql(DISCOVERY_TEST["dbscan_eps"], DISCOVERY_TEST["dbscan_min_samples"],
                                              DISCOVERY_TEST["char_n"]),
                                 O.cluster_stats_sql(DISCOVERY_TEST["dbscan_min_samples"],
                                                     DISCOVERY_TEST["min_matches_per_player"])
                                 ).replace("WITH ", "WITH RECURSIVE ", 1)
        + "SELECT g.match_id AS group_match_id, g.player_id AS group_player_id, l.match_id AS cluster_match_id, "
          "l.player_id AS cluster_player_id, r.match_id AS rep_match_id, r.player_id AS rep_player_id, "
          "c.num_matches, c.winrate, c.num_players, c.avg_ngram, c.avg_jaccard "
          "FROM cstats c JOIN walk g ON g.rk = c.leader JOIN walk l ON l.rk = c.label JOIN walk r ON r.rk = c.rep",
        "leader_groups": O.with_(*op, O.UNKNOWN_ROWS, O.shingles_cte(SHINGLE_N), O.signature_cte(SHINGLE_N, NUM_PERM),
                                 O.leader_groups_sql(bands, rows)).replace("WITH ", "WITH RECURSIVE ", 1)
        + f"SELECT g.match_id AS group_match_id, g.player_id AS group_player_id, r.match_id, r.player_id, "
          f"r.civilization, r.map_type, r.win FROM members m JOIN kept USING (leader) "
          f"JOIN walk g ON g.rk = m.leader JOIN walk r ON r.rk = m.rk",
    }
    def clusters_of(op, p):
        eps, samples, char_n = p.get("dbscan_eps", 0.3), p.get("dbscan_min_samples", 50), p.get("char_n", p["ngram_n"])
        return (*op, O.UNKNOWN_ROWS, O.shingles_cte(p["ngram_n"]), O.signature_cte(p["ngram_n"], NUM_PERM), O.leader_groups_sql(bands, rows),
                O.dbscan_sql(eps, samples, char_n), O.cluster_stats_sql(samples, p["min_matches_per_player"]),
                O.CLUSTER_INDEL_PAIRS, O.indel_ctes("cl_pairs"), O.CLUSTER_INDEL)

    clusters = clusters_of(op, DISCOVERY_TEST)
    repeated = clusters_of((*op[:-1], O.openings_cte(100, "ranked_openings"), O.repeated_openings_cte(list(ACTIVITY_OF_EVENT_TYPE.values()))), DISCOVERY_RUN)
    cluster_columns = ("SELECT g.match_id AS group_match_id, g.player_id AS group_player_id, l.match_id AS cluster_match_id, "
                       "l.player_id AS cluster_player_id, c.num_matches, c.winrate, c.num_players, c.avg_ngram, c.avg_jaccard, v.avg_levenshtein "
                       "FROM cstats c JOIN clev v USING (leader, label) JOIN walk g ON g.rk = c.leader JOIN walk l ON l.rk = c.label")

    def recursive(*ctes: str) -> str:
        return O.with_(*ctes).replace("WITH ", "WITH RECURSIVE ", 1)

    disc |= {
        "indel_to_modal": recursive(*op, O.KNOWN_ROWS, O.KNOWN_INDEL_PAIRS, O.indel_ctes("kn_pairs"))
        + "SELECT DISTINCT k.strategy, k.build_order_seq, ROUND(n.ratio, 6) AS indel FROM kn k JOIN modal m USING (strategy) "
          "JOIN indel n ON n.a = k.build_order_seq AND n.b = m.rep_seq",
        "known_variation": recursive(*op, O.KNOWN_ROWS, O.grams_cte("kn_grams", "kn", "strategy, match_id, player_id", CHAR_N),
                                     O.PAIRWISE_KNOWN, O.KNOWN_INDEL_PAIRS, O.indel_ctes("kn_pairs"))
        + "SELECT k.strategy, COUNT(*) AS num_matches, "
          "ROUND(100 * AVG(CAST(len(list_intersect(list_distinct(k.acts), list_distinct(m.rep_acts))) AS DOUBLE)"
          " / len(list_distinct(list_concat(k.acts, m.rep_acts)))), 4) AS avg_jaccard, "
          "ROUND(100 * ANY_VALUE(CASE WHEN c.n > 1 THEN COALESCE(s.s, 0) / (c.n * (c.n - 1) / 2.0) ELSE 1.0 END), 4) AS avg_ngram, "
          "ROUND(100 * AVG(n.ratio), 4) AS avg_levenshtein "
          "FROM kn k JOIN modal m USING (strategy) JOIN kn_count c USING (strategy) LEFT JOIN kn_cos s USING (strategy) "
          "JOIN indel n ON n.a = k.build_order_seq AND n.b = m.rep_seq GROUP BY k.strategy",
        "unknown_clusters": recursive(*clusters) + cluster_columns,
        "unknown_clusters_repeated": recursive(*repeated) + cluster_columns,
        "clusters_published": recursive(*repeated) + cluster_columns,
        "silver_stored": out_base["events_clean"],
        "gold_published": out_base["player_summary"],
        "cluster_summary": recursive(*clusters)
        + "SELECT num_matches, num_players, ROUND(winrate, 2) AS winrate, avg_ngram, avg_jaccard, avg_levenshtein "
          "FROM cstats JOIN clev USING (leader, label)",
    }
    out = dict(out_base)
    out.update(disc)
    return out
