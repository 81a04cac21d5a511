"""Build-order sequences and their token forms.

A sequence is kept as an ``actions`` array in rank order; ``build_order_seq`` is its
comma-joined text. Every per-group list is bounded by the openings' ``top_n``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN_KEYS = ["match_id", "player_id", "civilization", "map_type", "win"]


def _ordered_actions() -> Column:
    ranked = F.array_sort(F.collect_list(F.struct("action_rank", "activity")))
    return F.transform(ranked, lambda x: x["activity"])


def known_sequences(openings: DataFrame) -> DataFrame:
    """Per (strategy, match, player) of a named strategy, the ordered actions."""
    return (openings.where(F.col("strategy").isNotNull() & (F.col("strategy") != "Unknown"))
            .groupBy("strategy", "match_id", "player_id")
            .agg(_ordered_actions().alias("actions"))
            .withColumn("build_order_seq", F.array_join("actions", ",")))


def unknown_sequences(openings: DataFrame) -> DataFrame:
    """Per (match, player, civilization, map, win) with strategy 'Unknown'."""
    return (openings.where(F.col("strategy") == "Unknown")
            .groupBy(*UNKNOWN_KEYS)
            .agg(_ordered_actions().alias("actions"))
            .withColumn("build_order_seq", F.array_join("actions", ",")))


def action_shingles(actions, n: int = 3) -> Column:
    """The n consecutive actions joined by '_' at every position; none when shorter."""
    a = F.col(actions) if isinstance(actions, str) else actions
    return F.when(F.size(a) >= n, F.transform(F.sequence(F.lit(1), F.size(a) - n + 1),
                                              lambda i: F.array_join(F.slice(a, i, n), "_"))) \
        .otherwise(F.array().cast("array<string>"))


def normalized_text(seq) -> Column:
    """Lower-cased text with runs of two or more blanks collapsed (char n-gram input)."""
    s = F.col(seq) if isinstance(seq, str) else seq
    return F.regexp_replace(F.lower(s), r"\s\s+", " ")


def char_ngrams(df: DataFrame, key_cols: list[str], seq_col: str = "build_order_seq",
                n: int = 3) -> DataFrame:
    """Counts of character n-grams per row key (long form: key…, gram, cnt).

    The normalized text is projected below the ``explode`` so it is computed once per row,
    not once per n-gram. A text shorter than ``n`` has no n-gram (a zero vector).
    """
    t = df.select(*key_cols, normalized_text(seq_col).alias("_t"))
    starts = F.when(F.length("_t") >= n, F.sequence(F.lit(1), F.length("_t") - n + 1))
    return (t.select(*key_cols, "_t", F.explode(starts).alias("_i"))
            .groupBy(*key_cols, F.substring("_t", F.col("_i"), n).alias("gram"))
            .agg(F.count("*").cast("int").alias("cnt")))


def modal_sequence(seqs: DataFrame, group_col: str, order_cols: list[str],
                   seq_col: str = "build_order_seq") -> DataFrame:
    """Per group the most frequent exact sequence; ties → first in ``order_cols`` order.

    Two partial aggregations (count per sequence, then a min over (−count, first order)),
    so no group is ever gathered into one task.
    """
    first = F.struct(*[F.col(c) for c in order_cols])
    per_seq = seqs.groupBy(group_col, seq_col).agg(F.count("*").alias("_n"), F.min(first).alias("_first"))
    best = per_seq.groupBy(group_col).agg(F.min(F.struct((-F.col("_n")).alias("neg"), F.col("_first"),
                                                         F.col(seq_col))).alias("_b"))
    return best.select(group_col, F.col(f"_b.{seq_col}").alias("rep_seq"))
