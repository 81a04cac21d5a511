"""Physical-plan properties that the scale design relies on."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF001

RELATIONAL = ["events_clean", "player_match_results", "player_strategy_usage", "player_summary", "apm",
              "age_timings", "openings", "winrate_civ", "winrate_strat", "players_by_elo", "apm_by_player",
              "opening_sequences", "action_step_counts", "action_step_matrix", "civ_winrates",
              "strategy_winrates", "civilizations", "known_sequences", "unknown_sequences", "action_shingles",
              "char_ngrams"]
ARROW_KERNEL = ["minhash_signatures", "lsh_buckets"]   # vectorized batch kernel, no row-at-a-time UDF


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", RELATIONAL + ARROW_KERNEL)
def test_no_pairs_no_python_full_scans(spark, key):
    plan = _plan(E.queries()[key](spark, SF001))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan
    if key in RELATIONAL:
        assert "ArrowEvalPython" not in plan
    # the events scan reads only the columns the adapter needs, never `value`/`props`
    for line in plan.splitlines():
        if "FileScan parquet" in line and "events.parquet" in line:
            assert "props" not in line and "value:" not in line, line


def test_top_n_is_limited_before_the_shuffle(spark):
    plan = _plan(E.queries()["openings"](spark, SF001))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_total_games_is_a_scalar_subquery(spark):
    plan = _plan(E.queries()["winrate_civ"](spark, SF001))
    assert "Subquery" in plan and "CartesianProduct" not in plan


@pytest.fixture()
def small_skew(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "5000",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "5000",
            "spark.sql.files.maxPartitionBytes": "40000", "spark.sql.files.openCostInBytes": "0",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _final_plans(monkeypatch, module):
    """Labels of the intermediate tables a module stores → the plan that made each, as executed."""
    from warband.session import materialize
    plans = {}

    def recorded(df, label):
        df.collect()
        plans.setdefault(label, _plan(df))
        return materialize(df, label)

    monkeypatch.setattr(module, "materialize", recorded)
    return plans


def test_a_hot_bucket_is_split(spark, small_skew, monkeypatch):
    from pyspark.sql import functions as F

    from warband.operators import leaders
    plans = _final_plans(monkeypatch, leaders)
    n = 30_000
    buckets = spark.range(n, numPartitions=8).select(F.col("id").alias("sid"), F.lit(0).alias("band"),
                                                     F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id")).alias("bucket"))
    buckets = buckets.withColumn("bucket", F.array("bucket"))
    groups = leaders.leader_groups(buckets, buckets.select("sid", F.lit(1).alias("weight")), task_rows=1_000)
    assert groups.count() == n // 2 and groups.select("leader").distinct().count() == 1
    assert "skew=true" in plans["group-members"]
    # the round's join reads two stored tables by plain shuffles, the form whose hot partitions Spark splits
    lines = plans["round-leaders"].split("== Initial Plan ==")[1].splitlines()
    at = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line)
    assert "Sort" in lines[at + 1] and "Exchange hashpartitioning(k1" in lines[at + 2] and "HashAggregate" not in lines[at + 3]


def test_a_gram_of_all_members_is_split(spark, small_skew):
    from pyspark.sql import functions as F

    from warband.operators.similarity import medoid
    from warband.session import materialize
    ids = spark.range(30_000, numPartitions=8).select(F.col("id").alias("sid"))
    members = materialize(ids.select((F.col("sid") * 0).alias("ckey"), "sid", F.lit(1).alias("weight")), "m")
    vectors = materialize(ids.select("sid", F.lit("abc").alias("gram"), F.lit(1).alias("cnt")).union(
        ids.select("sid", (F.col("sid") % 40).cast("string"), F.lit(1)).where("sid < 4000")), "v")
    out = medoid(members, vectors)
    assert len(out.collect()) == 1
    # both sides of the gram join are plain shuffles, the form whose hot partitions Spark splits
    lines = _plan(out).splitlines()
    sides = [i for i, line in enumerate(lines) if "Sort [ckey" in line and " gram#" in line]
    assert len(sides) >= 2 and all("HashAggregate" not in lines[i + 1] for i in sides)


@pytest.mark.parametrize("measure", ["avg_jaccard", "avg_against_representative"])
def test_a_hot_cluster_is_split(spark, small_skew, monkeypatch, measure):
    from pyspark.sql import functions as F

    from warband.operators import similarity
    from warband.session import materialize
    plans = _final_plans(monkeypatch, similarity)
    n = 30_000
    ids = spark.range(n, numPartitions=8).select(F.col("id").alias("sid"))
    members = materialize(ids.select(F.when(F.col("sid") % 2 == 0, -1).otherwise(F.col("sid")).alias("ckey"), "sid", F.lit(1).alias("weight")), "m")
    acts = F.array(F.lit("a"), (F.col("sid") % 5).cast("string"), F.sha1(F.col("sid").cast("string")))
    seqs = materialize(ids.select("sid", acts.alias("actions"), F.array_join(acts, ",").alias("build_order_seq")), "s")
    reps = materialize(members.select("ckey").distinct().select("ckey", F.array(F.lit("a"), F.lit("0")).alias("rep_actions"), F.lit("a,0").alias("rep_seq")), "r")
    out = {r.ckey: r for r in getattr(similarity, measure)(members, seqs, reps).collect()}
    assert len(out) == n // 2 + 1 and abs(out[-1].avg_jaccard - (2 / 3 + 4 / 4) / 5) < 1e-9
    assert "skew=true" in plans["against-representatives"], plans["against-representatives"]


def test_discovery_reads_each_intermediate_a_bounded_number_of_times(spark):
    plan = _plan(E.queries()["cluster_stats"](spark, SF001))
    for label in ("clusters-", "sequence-rows-", "vectors-", "buckets-"):
        assert sum(label in line and "FileScan" in line for line in plan.splitlines()) <= 4, label
