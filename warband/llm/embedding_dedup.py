"""Near-duplicate vectors: random-hyperplane sign hashing, exact cosine check, connected components.

Equal vectors of a label are one class first. Each class is hashed into several tables; the bits of a
table key are the signs of dot products with fixed random directions. At angle θ two vectors agree in
one bit with probability 1 − θ/π, so at cosine 0.98 a key of ``k`` bits agrees with p = 0.936^k. ``k``
follows the logarithm of the row count (buckets of unrelated vectors stay small at every size) and the
number of tables follows from ``k`` so that a pair at the threshold is missed in all of them with
probability 1e-4 at most.

Buckets with several classes are compared by dot products in double precision, in blocks of bounded
size. A pair that shares several buckets counts in the first of its tables only, which the keys
themselves tell, so no pair list is stored. A block returns each class's link count and one edge to the
root of its local component, not its pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from warband.llm.common import components, stream_groups
from warband.session import materialize

BLOCK = 1_024
MISS = 1e-4


def table_layout(n: int, cosine: float) -> tuple[int, int]:
    """(bits per table, tables) for ``n`` vectors and a cosine threshold."""
    p = 1 - math.acos(cosine) / math.pi
    bits = min(40, max(8, math.ceil(math.log2(max(2, n)))))
    return bits, max(1, math.ceil(math.log(MISS) / math.log1p(-p ** bits)))


def table_keys(vectors: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """int64 keys [n, tables] of float64 vectors [n, dim]."""
    planes = np.random.default_rng([bits, tables, vectors.shape[1]]).standard_normal((vectors.shape[1], bits * tables))
    signs = (vectors @ planes > 0).reshape(len(vectors), tables, bits)
    return (signs * (1 << np.arange(bits, dtype=np.int64))).sum(axis=2)


def _local_roots(n: int, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Smallest index of each index's component under the given links."""
    root = np.arange(n)
    while True:
        low = root.copy()
        np.minimum.at(low, rows, root[cols])
        np.minimum.at(low, cols, root[rows])
        low = low[low]
        if (low == root).all():
            return root
        root = low


def near_duplicate_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                           label_col: str = "label", cosine: float = 0.98) -> DataFrame:
    """One row per input row: id, ``n_links``, ``component_id`` (smallest id reachable), ``kept``.

    Vectors are compared only under an equal, non-null label and of equal length. Null vectors, zero
    vectors and vectors with null or non-finite components link with nothing (component = own id).
    Rows that repeat a vector link with each other. Rows that repeat a whole row, id included, count as
    rows of their own. Other columns are not read. An empty table gives an empty result. Classes of
    equal vectors are told apart by 128 bits of hashes.
    """
    rows = vectors.select(vectors[id_col].cast("bigint").alias("id"), vectors[vector_col].cast("array<double>").alias("v"),
                          vectors[label_col].alias("label"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    usable = F.col("v").isNotNull() & F.col("label").isNotNull() & F.coalesce(finite & F.exists("v", lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("ok", usable & F.col("id").isNotNull())
    h1, h2 = F.xxhash64("label", "v"), F.xxhash64(F.lit(1), "v", "label")
    rows = materialize(rows.select("id", "ok", F.when(F.col("ok"), h1).alias("h1"), F.when(F.col("ok"), h2).alias("h2"),
                                   F.when(F.col("ok"), F.col("v")).alias("v"), "label"), "vectors")
    classes = materialize(rows.where("ok").groupBy("h1", "h2").agg(
        F.min("id").alias("rep"), F.count("*").alias("copies"), F.first("v").alias("v"),
        F.first(F.xxhash64("label")).alias("lab")), "vector-classes")
    n = classes.count()
    bits, tables = table_layout(n, cosine)
    names = ["rep", "copies", "lab", "dim", "unit", "keys"]
    schema = "rep bigint, copies bigint, lab bigint, dim int, unit array<double>, keys array<bigint>"

    def hashed(batches):
        for b in batches:
            size = pa.compute.list_value_length(b.column(3)).to_numpy(zero_copy_only=False)
            for d in np.unique(size):
                part = b.filter(pa.array(size == d))
                v = part.column(3).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, int(d))
                v = v / np.abs(v).max(axis=1, keepdims=True)
                unit = v / np.sqrt((v * v).sum(axis=1, keepdims=True))
                keys = table_keys(unit, bits, tables)
                offs = lambda w: pa.array(np.arange(len(unit) + 1, dtype=np.int32) * w)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), part.column(2), pa.array(np.full(len(unit), d, np.int32)),
                     pa.ListArray.from_arrays(offs(int(d)), pa.array(unit.ravel())),
                     pa.ListArray.from_arrays(offs(tables), pa.array(keys.ravel()))], names=names)

    reps = materialize(classes.select("rep", "copies", "lab", "v").mapInArrow(hashed, schema), "vector-keys")
    slots = reps.select("rep", "lab", "dim", F.posexplode("keys").alias("t", "key"))
    slot = ["lab", "dim", "t", "key"]
    shared = materialize(slots.groupBy(*slot).agg(F.count("*").alias("size")).where("size > 1"), "shared-slots")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    mine = F.pmod(F.xxhash64("rep", "t"), F.col("blocks")).cast("int")
    members = (slots.join(shared, slot).withColumn("blocks", blocks).withColumn("mine", mine)
               .select("rep", "t", F.xxhash64(*slot).alias("slot"), F.col("mine").alias("side"),
                       F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
               .select("rep", "t", "slot", "side", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j")))
    members = members.join(reps.select("rep", "copies", "unit", "keys"), "rep")
    group = ["slot", "i", "j"]
    out_schema = "rep bigint, links bigint, root bigint"

    def linked(batches):
        found: list[pa.RecordBatch] = []
        held = 0
        for g in stream_groups(batches, group):
            n = g.num_rows
            if n < 2:
                continue
            g = g.combine_chunks()
            col = lambda c: g.column(c).combine_chunks()
            flat = lambda c: (x := col(c)).flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
            units, keys = flat("unit"), flat("keys")
            rep, copies = col("rep").to_numpy(), col("copies").to_numpy()
            t, i, j = (g.column(c)[0].as_py() for c in ("t", "i", "j"))
            side = col("side").to_numpy()
            a = np.arange(n) if i == j else np.flatnonzero(side == i)
            b = a if i == j else np.flatnonzero(side == j)
            close = units[a] @ units[b].T >= cosine
            if i == j:
                close &= np.arange(n)[:, None] != np.arange(n)
            r, c = np.nonzero(close)
            earlier = (keys[a[r], :t] == keys[b[c], :t]).any(axis=1)
            r, c = a[r[~earlier]], b[c[~earlier]]
            if not len(r):
                continue
            links = np.bincount(r, copies[c], n).astype(np.int64)
            if i != j:
                links += np.bincount(c, copies[r], n).astype(np.int64)
            root = _local_roots(n, r, c)
            touched = np.flatnonzero(links)
            found.append(pa.RecordBatch.from_arrays([pa.array(rep[touched]), pa.array(links[touched]),
                                                     pa.array(rep[root[touched]])], names=["rep", "links", "root"]))
            held += len(touched)
            if held > 50_000:
                yield from found
                found, held = [], 0
        yield from found

    found = materialize(members.repartition(*group).sortWithinPartitions(*group).mapInArrow(linked, out_schema), "vector-links")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    comp = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    state = (classes.select("h1", "h2", "rep", "copies").join(links, "rep", "left")
             .join(comp.withColumnRenamed("node", "rep"), "rep", "left")
             .select("h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                     F.coalesce("component", "rep").alias("component_id")))
    state = materialize(state, "vector-state")
    return (rows.select("id", "h1", "h2").join(state, ["h1", "h2"], "left")
            .select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
                    F.coalesce("component_id", "id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True))))
