"""The driver's ``events`` table seen as a match log (bronze layout).

Every rule below is plain column arithmetic on ``events`` plus a lookup into the 25-row
``nation`` and 5-row ``region`` dimensions, so the same view can be written in any SQL
engine and the work grows with ``events``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from warband.schema import BRONZE_COLUMNS
from warband.sources.tables import load_table

# Fixed values of the adapter (shared with the SQL oracle).
ACTIVITY_OF_EVENT_TYPE = {
    "signup": "Upgrade Feudal Age",
    "purchase": "Upgrade Castle Age",
    "view": "Queue Villager",
    "click": "Build house",
    "error": "Queue Archer",
}
WIN_STRINGS = ["1", "True", "0", "FALSE", "x"]


def bronze_from_events(events: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """One bronze row per ``events`` row; match = (user, ten-day block)."""
    uid = F.col("user_id")
    block = F.expr("(day(ts) - 1) div 10")
    activity = F.lit(None).cast("string")
    for etype, name in ACTIVITY_OF_EVENT_TYPE.items():
        activity = F.when(F.col("event_type") == etype, F.lit(name)).otherwise(activity)
    strategy = (F.when(uid % 4 == 0, F.lit("Unknown"))
                .when(uid % 4 == 1, F.when(F.col("_b") == 0, "drush").otherwise("fast_castle"))
                .when(uid % 4 == 2, F.lit("drush"))
                .otherwise(F.when(F.col("_b") == 0, F.lit(None).cast("string")).otherwise("scout_rush")))
    eid = F.col("event_id")
    amount = F.when(eid % 5 == 0, F.concat((eid % 7).cast("string"), F.lit(".5"))) \
        .otherwise((eid % 7).cast("string"))

    # nation ⋈ region is a 25-row dimension; the planner broadcasts it by its size estimate
    # and falls back to a shuffle join if it were ever large.
    dim = nation.join(region, nation.n_regionkey == region.r_regionkey, "left") \
        .select(F.col("n_nationkey").alias("_nk"), F.col("n_name").alias("civilization"),
                F.col("r_name").alias("civilization_category"))

    ev = events.select("event_id", "ts", "user_id", "event_type").withColumn("_b", block)
    match_id = F.concat(F.lit("m"), uid.cast("string"), F.lit("_"), F.col("_b").cast("string"))
    out = (ev.join(dim, (ev.user_id % 25) == dim._nk, "left")
           .select(
               F.concat(match_id, F.lit("-"), eid.cast("string")).alias("event_id"),
               F.col("ts"),
               activity.alias("activity"),
               match_id.alias("match_id"),
               F.concat(F.lit("p"), uid.cast("string")).alias("player_id"),
               F.concat(F.lit("map"), (uid % 3).cast("string")).alias("map_type"),
               F.col("civilization"),
               F.col("civilization_category"),
               F.when(uid % 11 == 0, F.lit("n/a"))
                .otherwise((F.lit(800) + (uid * 37) % 2300).cast("string")).alias("elo"),
               match_id.alias("case_id"),
               strategy.alias("strategy"),
               F.element_at(F.array(*[F.lit(s) for s in WIN_STRINGS]),
                            ((uid * 7 + F.col("_b")) % 5 + 1).cast("int")).alias("win"),
               amount.alias("amount"),
               eid.cast("string").alias("@@index"),
               uid.cast("string").alias("@@case_index"),
           ))
    return out.select(*[F.col(f"`{c}`") for c in BRONZE_COLUMNS])


def load_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_from_events(load_table(spark, sf_dir, "events"), load_table(spark, sf_dir, "nation"),
                              load_table(spark, sf_dir, "region"))


def traces_from_bronze(bronze: DataFrame) -> DataFrame:
    """The same log as XES text: one ``xml`` row per match, events in order of their index."""
    def attr(tag: str, key: str, value):
        text = value.cast("string")
        for raw, escaped in (("&", "&amp;"), ("<", "&lt;"), ('"', "&quot;")):
            text = F.replace(text, F.lit(raw), F.lit(escaped))
        return F.coalesce(F.concat(F.lit(f'<{tag} key="{key}" value="'), text, F.lit('"/>')), F.lit(""))

    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    event = F.concat(F.lit("<event>"), attr("string", "concept:name", F.col("activity")), attr("date", "time:timestamp", stamp),
                     attr("string", "win", F.col("win")), attr("string", "amount", F.col("amount")),
                     attr("int", "@@index", F.col("`@@index`")), attr("int", "@@case_index", F.col("`@@case_index`")), F.lit("</event>"))
    own = ["case_id", "match_id", "player_id", "map_type", "civilization", "civilization_category", "strategy", "elo"]
    head = F.concat(*[attr("string", "concept:name" if c == "case_id" else c, F.col(c)) for c in own])
    return (bronze.select(*own, F.struct(F.col("`@@index`").cast("bigint").alias("i"), event.alias("xml")).alias("e"))
            .groupBy(*own).agg(F.sort_array(F.collect_list("e")).alias("es"))       # bounded by one match
            .select(F.concat(F.lit("<trace>"), head, F.array_join(F.transform("es", lambda e: e["xml"]), ""), F.lit("</trace>")).alias("xml")))
