"""Gold tables over ``events_clean``.

Each job is a pure ``DataFrame → DataFrame`` function; ``run_metrics`` writes them.
All group-bys aggregate partially before their shuffle, so a hot key only costs one
pre-aggregated row per map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from warband.functions.casts import word_match
from warband.sources.publish import publish_path, publish_table


def player_match_results(silver: DataFrame) -> DataFrame:
    """G1: one row per (player, match) with the highest elo and win flag seen."""
    return (silver.groupBy("match_id", "player_id")
            .agg(F.max("elo").alias("elo"), F.max("win").alias("win"))
            .select("player_id", "match_id", "elo", "win"))


def _sorted_join(values, sep: str):
    """Sorted, ``sep``-joined strings; NULL when there are none (like STRING_AGG)."""
    arr = F.array_sort(values)
    return F.when(F.size(arr) > 0, F.array_join(arr, sep))


def player_strategy_usage(silver: DataFrame) -> DataFrame:
    """Per player, ``'strategy - n'`` for every non-NULL strategy, n = distinct matches."""
    # Dedupe on all three keys first (spreads a hot player over many tasks), then count with
    # partial aggregation; a single count_distinct would shuffle on (player, strategy) only.
    per_strategy = (silver.where(F.col("strategy").isNotNull())
                    .select("player_id", "match_id", "strategy").distinct()
                    .groupBy("player_id", "strategy")
                    .agg(F.count("*").alias("matches_with_strategy")))
    return per_strategy.groupBy("player_id").agg(
        _sorted_join(F.collect_list(F.concat(F.col("strategy"), F.lit(" - "),
                                             F.col("matches_with_strategy").cast("string"))),
                     ", ").alias("used_strategies"))


def player_summary(silver: DataFrame, pmr: DataFrame | None = None) -> DataFrame:
    """Per player max elo, matches, wins, losses (NULL win counts as a loss), winrate.

    The per-player aggregate runs before the join, so both join sides are one row per
    player and already hash-partitioned on it.
    """
    pmr = player_match_results(silver) if pmr is None else pmr
    wins = F.sum("win")
    per_player = (pmr.where(F.col("player_id").isNotNull())
                  .groupBy("player_id")
                  .agg(F.max("elo").alias("max_elo"),
                       F.count("*").alias("total_matches"),   # pmr is unique per match
                       wins.alias("total_wins"),
                       (F.count("*") - wins).alias("total_loses"),
                       (wins.cast("double") / F.count("*")).alias("winrate")))
    return (per_player.join(player_strategy_usage(silver), "player_id", "left")
            .select("player_id", "max_elo", "total_matches", "total_wins", "total_loses",
                    "winrate", "used_strategies"))


def apm(silver: DataFrame, window_s: float = 600) -> DataFrame:
    """Actions per minute over the first ``window_s`` seconds (inclusive)."""
    return (silver.where(F.col("seconds_since_start") <= F.lit(window_s))
            .groupBy("match_id", "player_id")
            .agg((F.count("*").cast("double") * 60.0 / float(window_s)).alias("apm")))


def age_timings(silver: DataFrame, word: str = "age") -> DataFrame:
    """Mean minute of every activity naming ``word`` as a whole word, per civilization."""
    return (silver.where(word_match(F.lower("activity"), word))
            .groupBy("civilization", "activity")
            .agg(F.round(F.avg("seconds_since_start") / 60.0, 2).alias("avg_time_mins")))


def rank_window():
    """Actions of a (match, player) in time order; ties broken by index, then id."""
    return Window.partitionBy("match_id", "player_id").orderBy(
        F.asc_nulls_last("seconds_since_start"), F.asc_nulls_last("event_index"),
        F.asc_nulls_last("event_id"))


def openings(silver: DataFrame, top_n: int = 100, pmr: DataFrame | None = None) -> DataFrame:
    """The first ``top_n`` actions of every (match, player), with the match's win flag.

    The rank filter becomes a ``WindowGroupLimit`` before the shuffle, so no task ever holds
    more than ``top_n`` rows of one group; the win flag comes from the grouped G1 table,
    joined on the same partitioning.
    """
    pmr = player_match_results(silver) if pmr is None else pmr
    ranked = (silver.select("civilization", "civilization_category", "map_type", "strategy",
                            "match_id", "player_id", "elo", "activity", "seconds_since_start",
                            "event_index", "event_id")
              .withColumn("action_rank", F.row_number().over(rank_window()))
              .where(F.col("action_rank") <= top_n))
    return (ranked.join(pmr.select("match_id", "player_id", "win"), ["match_id", "player_id"], "left")
            .select("civilization", "civilization_category", "map_type", "strategy", "match_id",
                    "player_id", "elo", "activity", "action_rank", "win"))


def _win_share() -> list:
    return [(F.count_if(F.col("win") == 1).cast("double") / F.count("*")).alias("winrate"),
            F.count("*").alias("total_games")]


def winrate_civ(silver: DataFrame) -> DataFrame:
    """Per civilization win share, games, and share of all games.

    Games are distinct (match, player, civilization, win) rows; a NULL win is a loss. The
    total of all games is a scalar subquery (one number), not a join.
    """
    base = (silver.where(F.col("civilization").isNotNull())
            .select("match_id", "player_id", "civilization", "win").distinct())
    per_civ = base.groupBy("civilization").agg(*_win_share())
    all_games = per_civ.select(F.sum("total_games")).scalar()
    return per_civ.select("civilization", "winrate", "total_games",
                          (F.col("total_games").cast("double") / all_games).alias("playrate"))


def winrate_strat(silver: DataFrame) -> DataFrame:
    """Per strategy win share, games and the sorted list of civilizations played."""
    base = (silver.where(F.col("strategy").isNotNull())
            .select("strategy", "match_id", "player_id", "civilization", "win").distinct())
    return base.groupBy("strategy").agg(
        *_win_share(),
        _sorted_join(F.collect_set("civilization"), ", ").alias("civilizations"))


GOLD_TABLES = ("player_match_results", "player_summary", "apm", "age_timings", "openings",
               "winrate_civ", "winrate_strat")


def gold_frames(silver: DataFrame, pmr: DataFrame | None = None) -> dict[str, DataFrame]:
    pmr = player_match_results(silver) if pmr is None else pmr
    return {
        "player_match_results": pmr,
        "player_summary": player_summary(silver, pmr),
        "apm": apm(silver),
        "age_timings": age_timings(silver),
        "openings": openings(silver, pmr=pmr),
        "winrate_civ": winrate_civ(silver),
        "winrate_strat": winrate_strat(silver),
    }


def run_metrics(spark: SparkSession, silver_table: str, database: str = "gold") -> list[str]:
    """Build every gold table from a stored silver table, replacing old versions (see ``sources.publish``).

    ``player_match_results`` is written first and read back for the two tables that use it,
    as the reference does with its stored table.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    silver = spark.table(silver_table)
    publish_table(player_match_results(silver), f"{database}.player_match_results")
    frames = gold_frames(silver, spark.table(f"{database}.player_match_results"))
    for name in GOLD_TABLES[1:]:
        publish_table(frames[name], f"{database}.{name}")
    return list(GOLD_TABLES)


def write_gold(silver: DataFrame, path: str) -> list[str]:
    """G9 without a catalog: every gold table as a parquet folder under ``path``, old versions replaced."""
    spark = silver.sparkSession
    base = path.rstrip("/")
    publish_path(player_match_results(silver), f"{base}/player_match_results")
    frames = gold_frames(silver, spark.read.parquet(f"{base}/player_match_results"))
    for name in GOLD_TABLES[1:]:
        publish_path(frames[name], f"{base}/{name}")
    return list(GOLD_TABLES)
