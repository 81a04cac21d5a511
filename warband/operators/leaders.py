"""Greedy candidate groups from LSH buckets.

Sequential rule being reproduced: walk the sequences in order; a sequence not yet visited
takes every sequence sharing a bucket with it as its group and marks them visited. So a
sequence leads a group iff no earlier leader shares a bucket with it — the
lexicographically-first maximal independent set of the "shares a bucket" graph.

Whether a sequence leads depends only on earlier sequences of its own connected part of the
bucket graph, so the walk is cut there:

* Bucket rows that fit one task are walked in one task, a set of taken buckets being all it keeps.
* More rows are split into connected components first (labels on the star "sequence – smallest
  sequence of the bucket", linear in the rows). Components that fit a task are packed into tasks of
  ``task_rows`` rows and each task walks its own.
* A larger component is settled in rounds. Each round walks the open sequences that come first and fit
  one task, and besides makes a leader of every open sequence that is the smallest open one in *all* of
  its buckets; sequences sharing a bucket with a new leader are covered. The first part settles
  ``task_rows`` rows a round whatever the order (a chain in walk order costs no round per link), the
  second everything whose order is unrelated to similarity within a few rounds (Blelloch, Fineman and
  Shun, SPAA 2012); what is left and fits a task ends it.

Only the bipartite (sequence, bucket) table is used, never pairs. Round tables are written to the
checkpoint folder. Only row counts reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from warband.operators.dbscan import components
from warband.session import checkpoint_dir, materialize, materialize_observed

TASK_ROWS = 500_000          # bucket rows walked by one task
KEY = ["k1", "k2"]


def walk(batches: Iterable[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Leaders among rows ``(sid, k1, k2)`` sorted by ``sid``: a sequence none of whose keys is taken is one, and takes its keys."""
    taken: set[tuple[int, int]] = set()
    last, keys, free = None, [], True
    for b in batches:
        led = []
        for sid, *key in zip(*(c.to_pylist() for c in b.columns)):
            key = tuple(key)
            if sid != last:
                if last is not None and free:
                    taken.update(keys)
                    led.append(last)
                last, keys, free = sid, [], True
            if key in taken:
                free = False
            keys.append(key)
        yield np.array(led, np.int64)
    if last is not None and free:
        yield np.array([last], np.int64)


def _walked(rows: DataFrame) -> DataFrame:
    """Leaders of each partition's rows, a partition being closed under shared keys."""
    def run(batches):
        for led in walk(batches):
            if len(led):
                yield pa.RecordBatch.from_arrays([pa.array(led)], names=["sid"])
    return rows.select("sid", *KEY).sortWithinPartitions("sid").mapInArrow(run, "sid bigint")


def _covered(rows: DataFrame, leaders: DataFrame) -> DataFrame:
    """Sequences sharing a key with a leader, the leaders included."""
    keys = materialize(rows.join(leaders, "sid", "left_semi").select(*KEY).distinct(), "leader-buckets")
    return rows.join(keys, KEY, "left_semi").select("sid").distinct()


def leader_rounds(buckets: DataFrame, max_rounds: int | None = None, task_rows: int = TASK_ROWS) -> tuple[DataFrame, int]:
    """Leaders among ``buckets`` rows ``(sid, band, bucket)``, ``sid`` being the walk order, and the rounds used
    after the component split (0 where every component fits a task).

    Buckets are told apart by 128 hash bits of (band, bucket). ``max_rounds`` is an optional guard.
    """
    spark = buckets.sparkSession
    checkpoint_dir(spark)
    rows, m = materialize_observed(buckets.select("sid", F.xxhash64("band", "bucket").alias("k1"), F.xxhash64(F.lit(1), "bucket", "band").alias("k2")),
                                   "leader-rows", rows=F.count("*"))
    if m["rows"] <= task_rows:
        return materialize(_walked(rows.coalesce(1)), "leaders"), 0
    low = materialize(rows.groupBy(*KEY).agg(F.min("sid").alias("v")), "bucket-minima")
    star = rows.join(low, KEY).where("sid <> v").select(F.lit(0).alias("g"), F.col("sid").alias("u"), "v").distinct()
    parts = components(star, rows.select(F.lit(0).alias("g"), "sid").distinct()).select("sid", F.col("label").alias("part"))
    rows, m = materialize_observed(rows.join(parts, "sid"), "leader-parts", rows=F.count("*"))
    sizes = materialize(rows.groupBy("part").agg(F.count("*").alias("n")), "part-sizes")
    large = sizes.where(F.col("n") > task_rows).select("part")
    bins = max(1, -(-2 * m["rows"] // task_rows))
    small = rows.join(large, "part", "left_anti").withColumn("bin", F.pmod(F.xxhash64("part"), F.lit(bins)))
    found = [materialize(_walked(small.repartition(bins, "bin")), "leaders")]
    und, m = materialize_observed(rows.join(large, "part", "left_semi").select("sid", *KEY), "leader-open", rows=F.count("*"))
    rounds = 0
    while m["rows"] > 0:
        rounds += 1
        if max_rounds is not None and rounds > max_rounds:
            raise RuntimeError(f"leader selection did not settle in {max_rounds} rounds")
        if m["rows"] <= task_rows:
            found.append(materialize(_walked(und.coalesce(1)), "leaders"))
            break
        # the rows of the first sequences that fit a task; the last of them may be cut, so it waits
        first = und.orderBy("sid").limit(task_rows)
        last = first.agg(F.max("sid")).first()[0]
        walked = _walked(und.where(F.col("sid") < last).repartition(1))
        # stored first: as an aggregate below the join it would be partitioned by the key already, and a
        # hot bucket's rows could not be split over tasks
        low = materialize(und.groupBy(*KEY).agg(F.min("sid").alias("_m")), "bucket-minima")
        smallest = (und.join(low, KEY).groupBy("sid").agg(F.bool_and(F.col("_m") == F.col("sid")).alias("_ok"))
                    .where("_ok").select("sid"))
        leaders = materialize(walked.union(smallest).distinct(), "round-leaders")
        found.append(leaders)
        und, m = materialize_observed(und.join(_covered(und, leaders), "sid", "left_anti"), "leader-open", rows=F.count("*"))
    leaders = found[0]
    for part in found[1:]:
        leaders = leaders.unionByName(part)
    return leaders, rounds


def leader_groups(buckets: DataFrame, weights: DataFrame, max_rounds: int | None = None, task_rows: int = TASK_ROWS) -> DataFrame:
    """(leader, sid) rows — each leader with every sequence sharing a bucket with it.

    ``weights`` is (sid, weight): the number of identical copies a distinct sequence stands
    for. Groups whose total weight is 1 are dropped (a lone sequence is no group). No two
    leaders share a bucket, so the membership join emits at most one row per bucket row.
    Groups may overlap: a covered sequence can share buckets with several leaders.
    """
    leaders, _ = leader_rounds(buckets, max_rounds, task_rows)
    bk = buckets.select("sid", "band", "bucket")
    lead_b = materialize(bk.join(leaders, "sid").select("band", "bucket", F.col("sid").alias("leader")), "leaders-of-buckets")
    members = materialize(bk.join(lead_b, ["band", "bucket"]).select("leader", "sid").distinct(), "group-members")
    sizes = members.join(weights, "sid").groupBy("leader").agg(F.sum("weight").alias("_w"))
    return members.join(sizes.where(F.col("_w") > 1).select("leader"), "leader")
