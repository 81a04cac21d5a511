"""Silver layer: the typed, filtered ``events_clean`` table (I4) and its layout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from warband.functions.casts import elapsed_seconds, lenient_int, strict_double, win_flag
from warband.schema import SILVER_COLUMNS
from warband.session import materialize
from warband.sources.publish import publish_path, publish_table


def events_clean(bronze: DataFrame) -> DataFrame:
    """Filter rows without activity/match/player, type the attributes, add elapsed seconds.

    The start time of a case is the minimum ``ts`` of the *kept* rows of that case
    (NULL case ids form one case). It is computed as a grouped aggregate (partial
    aggregation before the shuffle, so one huge case costs no single task) and joined back
    with a null-safe key; AQE broadcasts the per-case table at run time when it is small and
    splits skewed partitions of the sort-merge join otherwise.
    """
    kept = bronze.where(F.col("activity").isNotNull() & F.col("match_id").isNotNull()
                        & F.col("player_id").isNotNull())
    starts = kept.groupBy(F.col("case_id").alias("_case")).agg(F.min("ts").alias("_start"))
    joined = kept.join(starts, kept["case_id"].eqNullSafe(starts["_case"]), "left")
    return joined.select(
        "event_id", "match_id", "player_id", "map_type", "civilization", "civilization_category",
        "strategy",
        strict_double("elo").alias("elo"),
        win_flag("win").alias("win"),
        "activity",
        lenient_int("amount").alias("amount"),
        F.col("ts").alias("event_time"),
        elapsed_seconds("_start", "ts").alias("seconds_since_start"),
        lenient_int("`@@index`").alias("event_index"),
        lenient_int("`@@case_index`").alias("case_index"),
    ).select(*SILVER_COLUMNS)


MATCH_KEY = ("match_id", "player_id")
HOT_SHARE = 4                # a bucketed table is written where no (match, player) holds more rows than so many average buckets


def write_silver(silver: DataFrame, path: str) -> None:
    """Write silver clustered by (match_id, player_id) — the key of every gold group-by.

    ``rebalance`` lets AQE split a partition that one huge match would otherwise own;
    sorting within files gives tight min/max statistics for match/player lookups (the
    reference's two secondary indexes become this layout).
    """
    publish_path(silver.hint("rebalance", *MATCH_KEY).sortWithinPartitions(*MATCH_KEY, "seconds_since_start"), path)


def store_silver(silver: DataFrame, table: str, buckets: int = 64) -> bool:
    """Silver as a catalog table bucketed and sorted by (match_id, player_id); True if it was bucketed.

    Gold group-bys and the openings' ranks and join read buckets without an exchange. A bucket is one
    task, so a table in which one (match, player) outweighs ``HOT_SHARE`` average buckets is stored in the clustered
    layout of ``write_silver`` instead, whose hot rows Spark can split. Old versions are replaced: the rows are
    written beside and renamed."""
    spark = silver.sparkSession
    silver = materialize(silver, "silver")
    rows, most = silver.groupBy(*MATCH_KEY).agg(F.count("*").alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    if most * buckets > HOT_SHARE * rows:
        publish_table(silver.hint("rebalance", *MATCH_KEY).sortWithinPartitions(*MATCH_KEY, "seconds_since_start"), table)
        return False
    # one file a bucket: every task would else write a file for each of its buckets
    publish_table(silver.repartition(buckets, *MATCH_KEY), table, bucket_by=(buckets, MATCH_KEY))
    return True
