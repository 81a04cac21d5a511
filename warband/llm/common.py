"""Helpers shared by the operators: folds, stable samples, streamed groups, connected components."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from warband.session import materialize


def held_out(id_col: Column) -> Column:
    """True for rows of the test fold: crc32 of the id's text divisible by 5."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def row_key(id_col: str | Column, text_col: str | Column) -> list[Column]:
    """128 hash bits of a row's id and text; rows that repeat both are one document."""
    return [F.xxhash64(id_col, text_col).alias("k1"), F.xxhash64(F.lit(3), text_col, id_col).alias("k2")]


def bounded_sample(rows: DataFrame, key: str, bound: int) -> DataFrame:
    """At most about ``bound`` rows, chosen by a hash of ``key``: all rows where they fit the bound. A fit's
    input only (see the callers' documented parameters); nothing is scored on it."""
    n = rows.count()
    if n <= bound:
        return rows
    share = math.floor(bound / n * (1 << 20))
    return rows.where(F.pmod(F.xxhash64(F.col(key), F.lit(7)), F.lit(1 << 20)) < share)


def regular_vectors(vectors: DataFrame, id_col: str, vector_col: str, keep: dict[str, str] | None = None) -> tuple[DataFrame, int]:
    """Rows (id, v as array<double>, and the columns ``keep`` names) whose vector is not null, holds no null or
    non-finite entry and has the commonest length (of equally common ones the longest), and that length (0: none)."""
    rows = vectors.select(vectors[id_col].alias("id"), vectors[vector_col].cast("array<double>").alias("v"),
                          *[vectors[c].alias(name) for c, name in (keep or {}).items()])
    rows = rows.where(F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf")))))
    best = rows.groupBy(F.size("v").alias("d")).count().agg(F.max(F.struct("count", "d"))).first()[0]
    return (rows.where(F.size("v") == best.d), best.d) if best else (rows, 0)


def stream_groups(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Consecutive rows with equal ``keys`` of a sorted partition, one table per group, holding one
    batch and one group at a time."""
    import numpy as np
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        cols = [np.asarray(b.column(b.schema.get_field_index(k)).to_numpy(zero_copy_only=False)) for k in keys]
        change = np.zeros(b.num_rows, bool)
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        first = tuple(c[0] for c in cols)
        change[0] = last is not None and first != last
        cuts = np.flatnonzero(change)
        lo = 0
        for hi in cuts.tolist():
            if hi > lo:
                held.append(b.slice(lo, hi - lo))
            if held:
                yield pa.Table.from_batches(held)
            held, lo = [], hi
        held.append(b.slice(lo))
        last = tuple(c[-1] for c in cols)
    if held:
        yield pa.Table.from_batches(held)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of an undirected graph: (node, component = smallest node reachable).

    Alternates the large-star and small-star steps of Kiveris et al. (SoCC 2014) until the edge set no
    longer changes. Every step is a grouped minimum joined back on its key; the minima are stored
    first, so both join sides are plain shuffles and a hub's edges can be split over tasks. Each
    round's edges are written to the shared checkpoint folder. Only counts reach the driver.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    e = materialize(e, "links")
    seen = None
    while True:
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "large-star")
        star = (both.join(low, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                .distinct())
        star = materialize(star, "links")
        low = materialize(star.groupBy("u").agg(F.min("v").alias("m")), "small-star")
        e = star.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(
            low.select("u", F.col("m").alias("v"))).distinct()
        e = materialize(e, "links")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == seen:
            break
        seen = tuple(now)
    return e.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node").union(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
