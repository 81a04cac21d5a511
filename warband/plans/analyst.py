"""Analyst queries over the gold tables (D1–D9): the data work behind the dashboard.

Filter values are arguments. ``civs=None`` means every civilization (the dashboard's
default selection), which excludes rows without one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from warband.functions.casts import short_id
from warband.session import materialize

MAX_ACTIVITIES = 2_000

OPENING_KEYS = ["elo", "player_id", "match_id", "win", "civilization", "civilization_category",
                "map_type", "strategy"]


def _civ_filter(col: str, civs):
    c = F.col(col)
    if civs is None:
        return c.isNotNull()
    return c.isin(list(civs))  # an empty selection gives an empty result


def players_by_elo(player_summary: DataFrame, lo: float = 2500, hi: float = 3100) -> DataFrame:
    """Player summaries with ``lo <= max_elo <= hi``, ids cut to 8 characters."""
    return (player_summary.where(F.col("max_elo").between(lo, hi))
            .withColumn("player_id", short_id("player_id", 8)))


def apm_by_player(apm: DataFrame, silver: DataFrame, lo: float = 2500, hi: float = 3100,
                  civs=None) -> DataFrame:
    """APM rows with the (elo, civilization) seen in the match, filtered, distinct."""
    ctx = (silver.where(F.col("elo").between(lo, hi) & _civ_filter("civilization", civs))
           .select("elo", "player_id", "match_id", "civilization").distinct())
    return (apm.join(ctx, ["player_id", "match_id"])
            .select("elo", "player_id", "match_id", "apm", "civilization").distinct()
            .select("elo", short_id("player_id", 8).alias("player_id"),
                    short_id("match_id", 10).alias("match_id"), "apm", "civilization"))


def age_matrix(age_timings: DataFrame, civs=None) -> DataFrame:
    """D3: civilization × activity table of mean minutes.

    Columns are ordered by their mean over civilizations, ascending. A pivot needs its
    column names at plan time; they come from a one-row-per-activity aggregate of the
    stored gold rows. At most ``MAX_ACTIVITIES`` names make a table of columns; more raise.
    """
    rows = materialize(age_timings.where(_civ_filter("civilization", civs)), "age-timings")   # read twice, computed once
    order = (rows.groupBy("activity").agg(F.avg("avg_time_mins").alias("m"))
             .orderBy(F.asc_nulls_last("m"), "activity").limit(MAX_ACTIVITIES + 1).collect())
    if len(order) > MAX_ACTIVITIES:
        raise ValueError(f"more than {MAX_ACTIVITIES} age activities: use age_timings, the long form")
    names = [r["activity"] for r in order]
    return rows.groupBy("civilization").pivot("activity", names).agg(F.first("avg_time_mins"))


def opening_rows(openings: DataFrame, n: int = 50, lo: float = 2500, hi: float = 3100,
                 civs=None) -> DataFrame:
    """Openings filtered like the dashboard: rank ≤ n, elo range, civilization list."""
    return openings.where((F.col("action_rank") <= n) & F.col("elo").between(lo, hi)
                          & _civ_filter("civilization", civs))


def opening_sequences(openings: DataFrame, n: int = 50, lo: float = 2500, hi: float = 3100,
                      civs=None) -> DataFrame:
    """One row per (match, player): its first ``n`` actions joined by ' → '.

    Rows with a NULL in any grouping key are dropped; ids are cut after grouping. Each
    group holds at most ``n`` rows, so the ordered list is bounded.
    """
    rows = opening_rows(openings, n, lo, hi, civs).dropna(subset=OPENING_KEYS)
    seq = F.array_sort(F.collect_list(F.struct("action_rank", "activity")))
    return (rows.groupBy(*OPENING_KEYS)
            .agg(F.array_join(F.transform(seq, lambda x: x["activity"]), " → ").alias("activity"))
            .select("elo", short_id("player_id", 8).alias("player_id"),
                    short_id("match_id", 10).alias("match_id"), (F.col("win") == 1).alias("win"),
                    "civilization", "civilization_category", "map_type", "strategy", "activity")
            .orderBy(F.desc("elo")))   # display order: highest elo first (range-partitioned sort)


def action_step_counts(openings: DataFrame, n: int = 50, lo: float = 2500, hi: float = 3100,
                       civs=None) -> DataFrame:
    """D5 (long form): number of openings having ``activity`` at step ``action_rank``."""
    return (opening_rows(openings, n, lo, hi, civs)
            .groupBy("activity", "action_rank").agg(F.count("*").alias("n_actions")))


def action_step_matrix(openings: DataFrame, n: int = 50, lo: float = 2500, hi: float = 3100,
                       civs=None) -> DataFrame:
    """D5 (wide form): activity × step 1..n counts, missing cells 0.

    The step columns are known from ``n``, so the pivot needs no extra pass over the data.
    """
    counts = action_step_counts(openings, n, lo, hi, civs)
    wide = counts.groupBy("activity").pivot("action_rank", list(range(1, n + 1))).agg(F.first("n_actions"))
    return wide.fillna(0, subset=[str(i) for i in range(1, n + 1)])


def civ_winrates(winrate_civ: DataFrame, civs=None) -> DataFrame:
    """Civilization win rates for the selected civilizations."""
    return (winrate_civ.where(_civ_filter("civilization", civs))
            .select("civilization", "total_games", "winrate", "playrate"))


def strategy_winrates(winrate_strat: DataFrame, civs=None) -> DataFrame:
    """Strategies whose civilization list contains any selected name (substring test)."""
    if civs is None:
        cond = F.col("civilizations").isNotNull()
    elif len(civs) == 0:
        cond = F.lit(False)
    else:
        cond = reduce(lambda a, b: a | b, [F.col("civilizations").contains(c) for c in civs])
    return winrate_strat.where(cond).select("strategy", "total_games", "winrate", "civilizations")


def civilizations(silver: DataFrame) -> DataFrame:
    """The distinct non-NULL civilizations."""
    return silver.select("civilization").where(F.col("civilization").isNotNull()).distinct()


def cluster_summary(clusters: DataFrame) -> DataFrame:
    """Cluster table for display, best win rate first."""
    return (clusters.select("num_matches", "num_players", F.round("winrate", 2).alias("winrate"),
                            "avg_ngram", "avg_jaccard", "avg_levenshtein")
            .orderBy(F.desc_nulls_last("winrate"), F.desc("num_matches")))
