"""Writing layers: silver layout, gold tables, cluster publishing."""

import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001
from warband.plans.discovery import publish_clusters
from warband.plans.gold import GOLD_TABLES, apm, openings, player_match_results, run_metrics
from warband.plans.silver import store_silver, write_silver
from warband.registry import silver_of
from warband.sources.publish import publish_path, publish_table


def test_silver_layout_and_gold_tables(spark, scratch):
    silver = silver_of(spark, SF001)
    path = os.path.join(scratch, "silver")
    write_silver(silver, path)
    stored = spark.read.parquet(path)
    assert stored.count() == silver.count()
    spark.sql("CREATE DATABASE IF NOT EXISTS silver_db")
    stored.write.mode("overwrite").saveAsTable("silver_db.events_clean")
    written = run_metrics(spark, "silver_db.events_clean", "gold_t")
    assert sorted(written) == sorted(GOLD_TABLES)
    assert spark.table("gold_t.openings").count() == spark.table("gold_t.openings").select("match_id", "player_id", "action_rank").distinct().count()
    again = run_metrics(spark, "silver_db.events_clean", "gold_t")          # replaces, no duplicates
    assert again == written
    assert spark.table("gold_t.apm").count() == spark.table("gold_t.apm").select("match_id", "player_id").distinct().count()


def test_publish_only_when_non_empty(spark):
    df = spark.createDataFrame([(1, 5, 0.5, 2, 0.9, 0.8, 0.7)],
                               "cluster_id long, num_matches long, winrate double, num_players long, "
                               "avg_ngram double, avg_jaccard double, avg_levenshtein double")
    assert publish_clusters(spark, df, "gold_p.clusters")
    assert not publish_clusters(spark, df.where(F.lit(False)), "gold_p.clusters")
    assert spark.table("gold_p.clusters").count() == 1


def _exchanges(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1].count("Exchange hashpartitioning")


def test_bucketed_silver_saves_exchanges(spark, scratch):
    """G1, G4 and G6 read the stored table's buckets; from a plain folder each shuffles."""
    silver = silver_of(spark, SF001)
    assert store_silver(silver, "silver_buckets", buckets=4)
    silver.write.parquet(os.path.join(scratch, "plain"))
    stored, plain = spark.table("silver_buckets"), spark.read.parquet(os.path.join(scratch, "plain"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for job in (player_match_results, apm, openings):
            assert _exchanges(job(stored)) == 0 < _exchanges(job(plain))
            assert sorted(map(repr, job(stored).collect())) == sorted(map(repr, job(plain).collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_a_hot_match_is_not_bucketed(spark):
    silver = silver_of(spark, SF001)
    hot = silver.withColumn("match_id", F.when(F.hash("event_id") % 3 == 0, F.lit("m1")).otherwise(F.col("match_id"))).withColumn(
        "player_id", F.when(F.col("match_id") == "m1", F.lit("p1")).otherwise(F.col("player_id")))
    assert not store_silver(hot, "silver_hot", buckets=64)
    assert spark.table("silver_hot").count() == silver.count()


def _failing(spark):
    return spark.range(100, numPartitions=4).select(F.when(F.col("id") == 99, F.raise_error(F.lit("stopped half-way"))).otherwise(F.col("id")).cast("long").alias("id"))


def test_a_failed_write_leaves_the_old_table(spark, scratch):
    path, table = os.path.join(scratch, "t"), "publish_db.kept"
    for publish, read in ((lambda df: publish_path(df, path), lambda: spark.read.parquet(path)),
                          (lambda df: publish_table(df, table), lambda: spark.table(table))):
        publish(spark.range(5))
        with pytest.raises(Exception, match="stopped half-way"):
            publish(_failing(spark))
        assert read().count() == 5
        publish(read().union(spark.range(2)))            # the new version may read the old one, or have other columns
        assert read().count() == 7
        publish(spark.range(3).withColumn("x", F.lit("a")))
        assert read().columns == ["id", "x"] and read().count() == 3
    assert [f for f in os.listdir(scratch) if f.startswith("_")] == []


def test_a_process_that_ended_between_the_renames(spark, scratch):
    path = os.path.join(scratch, "t")
    publish_path(spark.range(5), path)
    os.rename(path, os.path.join(scratch, "_old_t"))
    with pytest.raises(Exception, match="stopped half-way"):
        publish_path(_failing(spark), path)
    assert spark.read.parquet(path).count() == 5
    spark.sql("CREATE DATABASE IF NOT EXISTS publish_db")
    publish_table(spark.range(5), "publish_db.moved")
    spark.sql("ALTER TABLE publish_db.moved RENAME TO publish_db.moved__old")
    with pytest.raises(Exception, match="stopped half-way"):
        publish_table(_failing(spark), "publish_db.moved")
    assert spark.table("publish_db.moved").count() == 5
