"""Hard-negative mining by score bounds along spanning trees of the anchors.

Entries count as whole numbers, so every score (inner product) is exact. The anchors are cut into blocks of
anchors near each other (their sign pattern under fixed random directions orders them), and each block gets a
minimum spanning tree over the distances between its anchors. For a candidate ``c``, an anchor ``q`` and its
parent ``p``, the score of ``q`` lies within ``|q − p|·|c|`` of that of ``p``; a parent known by bounds hands
its bounds on. Going down a tree level by level, a candidate is scored exactly against an anchor only where
the bounds overlap the window of scores that can still enter the anchor's result; edges of length zero (copies
of an anchor) hand exact scores on for nothing.

Two scans per block set. The first finds each anchor's positives: the window is what reaches the task's current
last place among its best. The second finds its negatives: the window is the range of all its positives, from
the current last place on. Anchors of a scan are broadcast, as many as fit a fixed size; more anchors take more
scans. A task keeps a batch of candidates, one block's bounds and the best rows of its anchors.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from warband.llm.common import regular_vectors
from warband.session import materialize

BLOCK = 512                  # anchors of a tree
BROADCAST_BYTES = 32 << 20   # vectors of one scan's anchors
BATCH = 2_048                # candidates looked at at once
PAIRS = 32_768               # scores computed at once where candidates are few
DENSE = 0.2                  # share of open candidates from which a level is scored as one product
SIGN_BITS = 24
SLACK = 1e-9                 # relative, over the rounding of distances and norms


@dataclass
class Tree:
    """A block's anchors, parents first. ``level[k]:level[k+1]`` are the anchors ``k`` edges below the root."""
    at: np.ndarray           # numbers of the anchors
    label: np.ndarray
    vec: np.ndarray
    x: np.ndarray
    parent: np.ndarray       # positions in this block
    edge: np.ndarray
    level: np.ndarray


def spanning_tree(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(order, parent, edge, level): a minimum spanning tree of the rows (Prim), parents first, by level."""
    n = len(x)
    norm = (x * x).sum(axis=1)
    best, parent = np.full(n, np.inf), np.zeros(n, np.int64)
    depth, edge, done = np.zeros(n, np.int64), np.zeros(n), np.zeros(n, bool)
    k = 0
    for _ in range(n):
        done[k] = True
        d = np.sqrt(np.maximum(norm + norm[k] - 2 * (x @ x[k]), 0))
        nearer = ~done & (d < best)
        best[nearer], parent[nearer] = d[nearer], k
        k = int(np.argmin(np.where(done, np.inf, best)))
        if not done[k]:
            depth[k], edge[k] = depth[parent[k]] + 1, best[k]
    order = np.argsort(depth, kind="stable")
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    return order, place[parent[order]], edge[order], np.searchsorted(depth[order], np.arange(depth.max() + 2))


def trees_of(at: np.ndarray, vec: np.ndarray, label: np.ndarray, x: np.ndarray) -> list[Tree]:
    """Trees over blocks of near anchors."""
    planes = np.random.default_rng(x.shape[1]).standard_normal((x.shape[1], SIGN_BITS))
    near = np.argsort(((x @ planes > 0) << np.arange(SIGN_BITS)[::-1]).sum(axis=1), kind="stable")
    out = []
    for lo in range(0, len(near), BLOCK):
        part = near[lo:lo + BLOCK]
        order, parent, edge, level = spanning_tree(x[part])
        part = part[order]
        out.append(Tree(at[part], label[part], vec[part], x[part], parent, edge, level))
    return out


class Best:
    """The first ``k`` (score falling, id rising, each id once) of the rows given for each of ``n`` slots."""

    def __init__(self, n: int, k: int):
        self.n, self.k = n, k
        self.slot, self.score, self.vec = np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)
        self.last = np.full(n, -np.inf)      # score at the last place of a full slot

    def add(self, slot: np.ndarray, score: np.ndarray, vec: np.ndarray) -> None:
        keep = score >= self.last[slot]
        if not keep.any():
            return
        slot, score, vec = (np.concatenate([a, b[keep]]) for a, b in ((self.slot, slot), (self.score, score), (self.vec, vec)))
        by = np.lexsort((vec, -score, slot))
        slot, score, vec = slot[by], score[by], vec[by]
        fresh = np.ones(len(slot), bool)
        fresh[1:] = (slot[1:] != slot[:-1]) | (score[1:] != score[:-1]) | (vec[1:] != vec[:-1])
        slot, score, vec = slot[fresh], score[fresh], vec[fresh]
        rank = np.arange(len(slot)) - np.searchsorted(slot, slot)
        first = rank < self.k
        self.slot, self.score, self.vec = slot[first], score[first], vec[first]
        full = rank == self.k - 1
        self.last[slot[full]] = score[full]


def open_scores(tree: Tree, x: np.ndarray, norm: np.ndarray, low: np.ndarray, high: np.ndarray, may: np.ndarray):
    """Per level of the tree: (anchor positions, candidate positions, exact scores) of the pairs that ``may``
    holds and whose bounds overlap the anchor's window ``low..high``."""
    m = len(x)
    floor, ceil = np.empty((len(tree.x), m)), np.empty((len(tree.x), m))
    for lo, hi in zip(tree.level, tree.level[1:]):
        rows = slice(lo, hi)
        if lo == 0:
            floor[rows], ceil[rows] = -np.inf, np.inf
        else:
            reach = tree.edge[rows, None] * norm * (1 + SLACK)
            floor[rows], ceil[rows] = floor[tree.parent[rows]] - reach, ceil[tree.parent[rows]] + reach
        known = floor[rows] == ceil[rows]
        wanted = may[rows] & (ceil[rows] >= low[rows, None]) & (floor[rows] <= high[rows, None])
        unknown = wanted & ~known
        if lo == 0 or unknown.mean() > DENSE:
            floor[rows] = ceil[rows] = tree.x[rows] @ x.T
        else:
            a, c = np.nonzero(unknown)
            for i in range(0, len(a), PAIRS):
                p, q = a[i:i + PAIRS], c[i:i + PAIRS]
                floor[lo + p, q] = ceil[lo + p, q] = np.einsum("ij,ij->i", tree.x[lo + p], x[q])
        a, c = np.nonzero(wanted)
        score = floor[lo + a, c]
        inside = (score >= low[lo + a]) & (score <= high[lo + a])
        yield lo + a[inside], c[inside], score[inside]


def _batches(batches, dim: int):
    """(vec, label, x, norm) of at most ``BATCH`` candidates at once."""
    for b in batches:
        for lo in range(0, b.num_rows, BATCH):
            part = b.slice(lo, BATCH)
            x = np.asarray(part.column(2).flatten()).reshape(part.num_rows, dim)
            yield np.asarray(part.column(0)), np.asarray(part.column(1)), x, np.sqrt((x * x).sum(axis=1))


def _result(columns: list, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in columns], names=names)


def mine_hard_negatives(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                        anchor_every: int = 50, positives: int = 5, negatives: int = 3, scale: int = 256,
                        window: tuple[int, int] = (50, 95)) -> DataFrame:
    """Per anchor and positive the first negatives: ``anchor_id``, ``positive_id``, ``rank``, ``negative_id``,
    ``positive_score``, ``negative_score``.

    An entry ``c`` counts as the whole number ``floor(scale·c)``; a row's score is its inner product with the
    anchor. Higher scores come first, equal ones by smaller id. Anchors are the rows whose id is divisible by
    ``anchor_every``. An anchor's positives are its first ``positives`` rows of another id and an equal label.
    Its negatives for a positive are the first ``negatives`` rows of another label with ``window[0]·positive ≤
    100·score ≤ window[1]·positive`` (of scores). Fewer are given where there are fewer.

    No part take rows with a null id, label or vector, with a null or non-finite entry, or with a vector of
    another length than the commonest (of equally common ones the longest). Rows that repeat id, label and
    vector count once; an id with several labels or vectors is so many anchors, and as a partner it counts once
    per score. Scores are exact while below 2^53. Empty tables and tables without anchors give an empty result.
    Extra columns are not read, whatever their names.

    A scan of the rows serves about ``BROADCAST_BYTES`` of anchors. Its tasks give at most ``positives`` (then
    ``positives · negatives``) rows per anchor, whatever the labels' sizes.
    """
    spark = vectors.sparkSession
    rows, dim = regular_vectors(vectors, id_col, vector_col, {label_col: "label"})
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull())
    rows = materialize(rows.select(F.col("id").cast("bigint").alias("vec"), F.xxhash64("label").alias("label"),
                                   F.transform("v", lambda c: F.floor(c * scale).cast("double")).alias("x")).distinct(), "mining-rows")
    anchors = rows.where(F.col("vec") % anchor_every == 0).withColumn("no", F.monotonically_increasing_id())
    anchors = materialize(anchors, "mining-anchors")
    per_scan = max(BLOCK, BROADCAST_BYTES // (8 * max(dim, 1)))
    scans = -(-anchors.count() // per_scan)
    out = None
    for s in range(scans):
        part = _scan(rows, anchors.where(F.pmod(F.xxhash64("no"), F.lit(scans)) == s), dim, positives, negatives, window)
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], SCHEMA) if out is None else out


SCHEMA = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


def _scan(rows: DataFrame, anchors: DataFrame, dim: int, positives: int, negatives: int, window: tuple[int, int]) -> DataFrame:
    spark = rows.sparkSession
    table = anchors.select("no", "vec", "label", "x").toArrow().combine_chunks()     # about BROADCAST_BYTES
    number, vec, label = (table.column(c).to_numpy() for c in ("no", "vec", "label"))
    x = np.asarray(table.column("x").combine_chunks().flatten()).reshape(table.num_rows, dim)
    forest = spark.sparkContext.broadcast(trees_of(number, vec, label, x))

    def nearest(batches):
        trees = forest.value
        best = [Best(len(t.x), positives) for t in trees]
        for c_vec, c_label, c, norm in _batches(batches, dim):
            for t, b in zip(trees, best):
                may = (t.label[:, None] == c_label) & (t.vec[:, None] != c_vec)
                for a, at, score in open_scores(t, c, norm, b.last, np.full(len(t.x), np.inf), may):
                    b.add(a, score, c_vec[at])
        if trees:
            yield _result([[t.at[b.slot] for t, b in zip(trees, best)], [b.vec for b in best], [b.score for b in best]],
                          ["no", "positive_id", "positive_score"])

    found = rows.select("vec", "label", "x").mapInArrow(nearest, "no bigint, positive_id bigint, positive_score double").distinct()
    first = Window.partitionBy("no").orderBy(F.desc("positive_score"), "positive_id")
    found = materialize(found.withColumn("place", F.row_number().over(first)).where(F.col("place") <= positives), "mining-positives")
    table = found.toArrow().combine_chunks()                                         # at most ``positives`` rows per anchor
    by_number = np.argsort(number)
    row = by_number[np.searchsorted(number, table.column("no").to_numpy(), sorter=by_number)]
    place = table.column("place").to_numpy() - 1
    partner, score = np.full((len(number), positives), -1, np.int64), np.full((len(number), positives), np.nan)
    partner[row, place], score[row, place] = table.column("positive_id").to_numpy(), table.column("positive_score").to_numpy()
    wanted = spark.sparkContext.broadcast((number[by_number], partner[by_number], score[by_number]))

    def hard(batches):
        trees = forest.value
        numbers, partners, scores = wanted.value
        rank = [np.searchsorted(numbers, t.at) for t in trees]
        least = [np.nan_to_num(window[0] * scores[r], nan=np.inf) for r in rank]     # nan: no such positive, an empty window
        most = [np.nan_to_num(window[1] * scores[r], nan=-np.inf) for r in rank]
        best = [Best(len(t.x) * positives, negatives) for t in trees]
        for c_vec, c_label, c, norm in _batches(batches, dim):
            for t, b, lo, hi in zip(trees, best, least, most):
                wide = np.where(lo <= hi, lo, np.inf)
                low = np.maximum(np.floor(wide / 100), b.last.reshape(lo.shape)).min(axis=1)
                high = np.ceil(np.where(lo <= hi, hi, -np.inf) / 100).max(axis=1)
                for a, at, score in open_scores(t, c, norm, low, high, t.label[:, None] != c_label):
                    i, j = np.nonzero((100 * score[:, None] >= lo[a]) & (100 * score[:, None] <= hi[a]))
                    b.add(a[i] * positives + j, score[i], c_vec[at[i]])
        if trees:
            i, j = zip(*[np.divmod(b.slot, positives) for b in best])
            yield _result([[t.at[p] for t, p in zip(trees, i)], [t.vec[p] for t, p in zip(trees, i)],
                           [partners[r[p], q] for r, p, q in zip(rank, i, j)],
                           [scores[r[p], q].astype(np.int64) for r, p, q in zip(rank, i, j)],
                           [b.vec for b in best], [b.score.astype(np.int64) for b in best], list(j)],
                          ["no", "anchor_id", "positive_id", "positive_score", "negative_id", "negative_score", "place"])

    columns = "no bigint, anchor_id bigint, positive_id bigint, positive_score bigint, negative_id bigint, negative_score bigint, place bigint"
    mined = rows.select("vec", "label", "x").mapInArrow(hard, columns).repartition("no", "place").distinct()
    first = Window.partitionBy("no", "place").orderBy(F.desc("negative_score"), "negative_id")
    mined = mined.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= negatives)
    return mined.select("anchor_id", "positive_id", F.col("rank").cast("int"), "negative_id", "positive_score", "negative_score")
