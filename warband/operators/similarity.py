"""Cohesion measures of a set of sequences against each other or a representative
(U11–U14). Every input is long-form and every step is a partial aggregation or an
equi-join, so a group of any size is spread over many tasks.

Inputs share one shape: ``members`` (ckey, sid, weight) — distinct sequences of a group,
``weight`` = how many rows carry that exact sequence; ``vectors`` (sid, gram, cnt).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from warband.functions.indel import indel_similarity
from warband.session import materialize


def avg_pairwise_cosine(members: DataFrame, vectors: DataFrame, ckey: str = "ckey") -> DataFrame:
    """Mean cosine over all unordered pairs of rows; 1.0 for a single row.

    Linear form: with unit vectors û and weights w, Σ_{i≠j} cos = ‖Σ w·û‖² − Σ w·‖û‖², over
    N(N−1) ordered pairs (N = Σ w). Zero vectors have cosine 0 with everything.
    """
    norms = vectors.groupBy("sid").agg(F.sqrt(F.sum(F.col("cnt") * F.col("cnt"))).alias("_nrm"))
    unit = vectors.join(norms, "sid").select("sid", "gram", (F.col("cnt") / F.col("_nrm")).alias("u"))
    s = (members.join(unit, "sid").groupBy(ckey, "gram")
         .agg(F.sum(F.col("weight") * F.col("u")).alias("_s"))
         .groupBy(ckey).agg(F.sum(F.col("_s") * F.col("_s")).alias("_ss")))
    self_ = (members.join(norms.select("sid", (F.col("_nrm") > 0).cast("double").alias("_n2")), "sid", "left")
             .groupBy(ckey).agg(F.sum(F.col("weight") * F.coalesce("_n2", F.lit(0.0))).alias("_self"),
                                F.sum("weight").alias("_N")))
    n = F.col("_N").cast("double")
    return (self_.join(s, ckey, "left")
            .select(ckey, F.when(F.col("_N") > 1, (F.coalesce("_ss", F.lit(0.0)) - F.col("_self")) / (n * (n - 1)))
                    .otherwise(F.lit(1.0)).alias("avg_ngram")))


def medoid(members: DataFrame, vectors: DataFrame, ckey: str = "ckey") -> DataFrame:
    """Per group the member closest (Euclidean, raw counts) to the weighted mean.

    ‖x − c‖² = ‖x‖² − 2x·c + ‖c‖², each term an aggregate. Ties (after rounding to 6
    decimals) go to the smallest sequence id, i.e. the first in walk order.
    """
    total = members.groupBy(ckey).agg(F.sum("weight").alias("_W"))
    mv = members.join(vectors, "sid")
    cent = (mv.groupBy(ckey, "gram").agg(F.sum(F.col("weight") * F.col("cnt")).alias("_wc"))
            .join(total, ckey).select(ckey, "gram", (F.col("_wc") / F.col("_W")).alias("_c")))
    cent = materialize(cent, "centroids")    # stored: a gram of all members of a big group can then be split over tasks
    c2 = cent.groupBy(ckey).agg(F.sum(F.col("_c") * F.col("_c")).alias("_c2"))
    xc = (mv.join(cent, [ckey, "gram"]).groupBy(ckey, "sid")
          .agg(F.sum(F.col("cnt") * F.col("_c")).alias("_xc"), F.sum(F.col("cnt") * F.col("cnt")).alias("_x2")))
    d = (members.join(xc, [ckey, "sid"], "left").join(c2, ckey, "left")
         .select(ckey, "sid", F.round(F.coalesce("_x2", F.lit(0.0)) - 2 * F.coalesce("_xc", F.lit(0.0))
                                     + F.coalesce("_c2", F.lit(0.0)), 6).alias("_d")))
    return d.groupBy(ckey).agg(F.min(F.struct("_d", "sid")).alias("_m")).select(ckey, F.col("_m.sid").alias("rep_sid"))


def _against_representative(members: DataFrame, seqs: DataFrame, reps: DataFrame, ckey: str, **measures) -> DataFrame:
    """Weighted means of row measures against the group's representative.

    The joined rows are stored with their measures: aggregated in the join's own stage they would have to stay
    partitioned by the group, and one large group's rows could not be split over tasks."""
    rows = members.join(seqs, "sid").join(reps, ckey)
    rows = materialize(rows.select(ckey, "weight", *[m.alias(n) for n, m in measures.items()]), "against-representatives")
    return rows.groupBy(ckey).agg(*[(F.sum(F.col("weight") * F.col(n)) / F.sum("weight")).alias(n) for n in measures])


def _jaccard():
    a, r = F.array_distinct("actions"), F.array_distinct("rep_actions")
    return F.try_divide(F.size(F.array_intersect(a, r)).cast("double"), F.size(F.array_union(a, r)))


def avg_jaccard(members: DataFrame, seqs: DataFrame, reps: DataFrame, ckey: str = "ckey") -> DataFrame:
    """Weighted mean Jaccard of action sets against the group's representative.

    ``seqs``: (sid, actions, …); ``reps``: (ckey, rep_actions, …).
    """
    return _against_representative(members, seqs, reps, ckey, avg_jaccard=_jaccard())


def avg_against_representative(members: DataFrame, seqs: DataFrame, reps: DataFrame,
                               ckey: str = "ckey") -> DataFrame:
    """U13 + U14: weighted means of Jaccard (action sets) and indel similarity (texts)
    between every row and its group's representative, in one pass.

    ``seqs``: (sid, actions, build_order_seq); ``reps``: (ckey, rep_actions, rep_seq).
    The indel kernel sees each distinct sequence of a group once, not every copy.
    """
    return _against_representative(members, seqs, reps, ckey, avg_jaccard=_jaccard(),
                                   avg_levenshtein=indel_similarity(F.col("build_order_seq"), F.col("rep_seq")))
