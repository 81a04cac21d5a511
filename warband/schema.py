"""Column layout of the bronze and silver layers."""

from pyspark.sql import types as T

# Column names and order of both layers.
# Bronze column order: the preferred attribute columns first; every other attribute key
# lands in ``attrs``.
BRONZE_COLUMNS = [
    "event_id", "ts", "activity", "match_id", "player_id", "map_type", "civilization",
    "civilization_category", "elo", "case_id", "strategy", "win", "amount", "@@index",
    "@@case_index",
]

BRONZE_SCHEMA = T.StructType(
    [T.StructField(c, T.TimestampType() if c == "ts" else T.StringType()) for c in BRONZE_COLUMNS]
    + [T.StructField("attrs", T.MapType(T.StringType(), T.StringType()))]
)

SILVER_COLUMNS = [
    "event_id", "match_id", "player_id", "map_type", "civilization", "civilization_category",
    "strategy", "elo", "win", "activity", "amount", "event_time", "seconds_since_start",
    "event_index", "case_index",
]
