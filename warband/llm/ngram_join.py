"""N-gram Jaccard join: an exact metric-space join of shingle sets, and its connected components.

Two sets link when their Jaccard distance is at most ε. The space is divided in three steps:

1. *Cells.* The pivots of the outer division are single shingles. A set's distance to ``{s}`` is below 1
   only for its own shingles, so its nearest pivots are those; one global order (frequent hash buckets last,
   then by hash) breaks the ties. A linked pair misses so few shingles of each other that both lie in the cell of
   a common pivot among the first ``n − ⌈(1−ε)·n⌉ + 1`` of each: the window in which boundary sets
   are replicated. Cells with one set hold no pair and go.
2. *Cells* are compared with one pivot of their own, one of their sets. Those that link with it hang together and need
   no comparison among themselves. Pairs with a set that does not are listed in small cells, each once over all
   cells. Before sets are fetched and compared, sizes (distance to the empty set) and a histogram over 256 shingle
   classes bound the distance from below and drop nearly all pairs.
3. *Large cells* not settled by their pivot keep the sets that, by sizes and histograms, may link with another one, and
   join recursively, cells of one pivot together: a set not yet in a region becomes a pivot, takes the sets within ε as its Voronoi region, and so on. Only sets within 2ε of another
   region's pivot, the boundary, can link into it; each is compared once more, unless the regions hang together
   by then. Links that join nothing new are not returned.

Every bound is the triangle inequality or an exact counting bound, so no link is lost and the
components are exact. Shingles and sets are known by 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from warband.llm.common import components, row_key, stream_groups
from warband.llm.shingle_sets import SHINGLE, WordHashes, _mix, shingle_rows, shingle_sets
from warband.session import drop_tables, materialize, scratch_scope

#: Links need 100 · intersection >= 85 · union.
NUM, DEN = 85, 100
SMALL_CELL = 128
PART = 512
BLOCK = 2_048
BUCKET_BITS = 18
CLASSES = 256
ROWS = 250


def _buckets(value: np.ndarray) -> np.ndarray:
    return (value >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def _texts(batches, columns: int):
    """Slices of at most ROWS rows: (other columns, texts as UTF-8 bytes)."""
    for big in batches:
        for lo in range(0, big.num_rows, ROWS):
            b = big.slice(lo, ROWS)
            yield [b.column(k) for k in range(columns)], b.column(columns).to_pylist()


def _digests(value: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One 64-bit digest per set, whatever the order of its hashes."""
    total = np.r_[np.uint64(0), np.cumsum(_mix(value ^ np.uint64(0x5851F42D4C957F2D)))]
    return _mix(total[offsets[1:]] - total[offsets[:-1]] + np.diff(offsets).astype(np.uint64))


def _lists(column) -> list[np.ndarray]:
    offs, values = column.offsets.to_numpy(), column.values.to_numpy()
    return [values[lo:hi] for lo, hi in zip(offs[:-1], offs[1:])]


def frequent_buckets(texts: DataFrame, size: int) -> np.ndarray:
    """Shingle counts of the hash buckets that stand out in some task's rows, 0 elsewhere.

    The counts only order shingles (any order keeps the join exact); they come from all rows, and a fixed
    number of buckets bounds what reaches the driver.
    """
    def counted(batches):
        known, total = WordHashes(), np.zeros(1 << BUCKET_BITS, np.int64)
        for _, rows in _texts(batches, 0):
            total += np.bincount(_buckets(shingle_rows(rows, known, size)[0]), minlength=1 << BUCKET_BITS)
        mean = total.mean()
        at = np.flatnonzero(total > mean + 4 * np.sqrt(mean) + 8)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    rows = texts.mapInArrow(counted, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(1 << BUCKET_BITS, np.int64)
    out[rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    return out


def linked(inter: np.ndarray, a: np.ndarray, b: np.ndarray, num: int = NUM, den: int = DEN) -> np.ndarray:
    return den * inter >= num * (a + b - inter)


def region_links(values: np.ndarray, offsets: np.ndarray, num: int = NUM, den: int = DEN) -> tuple[np.ndarray, np.ndarray]:
    """Links (index pairs) that hold the components of the given sets together, by pivot regions."""
    m = len(offsets) - 1
    size = np.diff(offsets)
    owner = np.repeat(np.arange(m), size)
    _, dense = np.unique(values, return_inverse=True)
    by = np.argsort(dense, kind="stable")
    holders, starts = owner[by], np.searchsorted(dense[by], np.arange(dense.max() + 2 if len(dense) else 1))

    def meet(p: int) -> np.ndarray:
        """Intersection sizes of set p with all sets, through the shingles' holders."""
        ids = dense[offsets[p]:offsets[p + 1]]
        lens = starts[ids + 1] - starts[ids]
        total = np.cumsum(lens)
        return np.bincount(holders[np.repeat(starts[ids] - total + lens, lens) + np.arange(total[-1])], minlength=m)

    eps = 1 - num / den
    root = np.arange(m)

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    a, b = [], []

    def join(x: int, y: int) -> None:
        rx, ry = find(x), find(y)
        if rx != ry:
            root[max(rx, ry)] = min(rx, ry)
            a.append(x)
            b.append(y)

    region = np.full(m, -1)
    pivots, close = [], []            # of each pivot, the sets that may link into its region
    while (free := np.flatnonzero(region < 0)).size:
        p = int(free[0])
        inter = meet(p)
        near = linked(inter, size, size[p], num, den)
        near[p] = True
        for x in np.flatnonzero(near).tolist():
            join(p, x)
        region[near & (region < 0)] = len(pivots)
        pivots.append(p)
        # a set linked into another region lies within 2ε of that region's pivot
        close.append(np.flatnonzero(1 - inter / (size + size[p] - inter) <= 2 * eps + 1e-5))
    if len(pivots) > 1:
        at = np.concatenate(close)
        by = np.argsort(at, kind="stable")
        of = np.repeat(pivots, list(map(len, close)))[by]
        ends = np.searchsorted(at[by], np.arange(m + 1))
        for x in np.flatnonzero(np.diff(ends) > 1).tolist():
            tops = {find(p) for p in of[ends[x]:ends[x + 1]].tolist()}
            if tops - {find(x)}:
                for y in np.flatnonzero(linked(meet(x), size, size[x], num, den)).tolist():
                    join(x, y)
    return np.array(a, np.int64), np.array(b, np.int64)


def ngram_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
                     num: int = NUM, den: int = DEN, with_keys: bool = False) -> DataFrame:
    """One row per input row: the id, ``n_shingles`` and ``component_id`` (smallest id reachable by links);
    ``with_keys`` adds ``group_key`` (a number of the component, null without words) and the row's ``k1`` and ``k2``.

    Null texts and texts without words have no shingles and link with nothing (their component is their own id). Equal sets link. Rows
    that repeat an id are rows of their own. A row with a null id links as any other but is never a component's id:
    its component is the smallest id it reaches, null if none. Other columns are not read. An empty table gives an
    empty result.
    """
    with scratch_scope() as tables:
        rows, named = _grouped(docs, id_col, text_col, size, num, den)
    # the result reads these two only; the others are freed before whatever comes next writes its own
    drop_tables(docs.sparkSession, [t for t in tables if t.rsplit("/", 1)[1].rsplit("-", 1)[0] not in ("set-rows", "node-components")])
    return rows.join(named, "node", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"),
        *([F.col("component").alias("group_key"), "k1", "k2"] if with_keys else []))


def _grouped(docs: DataFrame, id_col: str, text_col: str, size: int, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """(id, k1, k2, n, node) of all rows and (node, component, component_id) of all sets, both stored."""
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(docs[id_col].alias("id"), *row_key(docs[id_col], docs[text_col]), docs[text_col].cast("binary").alias("text"))
    order = docs.sparkSession.sparkContext.broadcast(frequent_buckets(texts.select("text"), size))   # 2^18 counts

    def described(batches):
        known = WordHashes()
        for (ids, k1, k2), rows in _texts(batches, 3):
            value, offs = shingle_sets(rows, known, size)
            n = np.diff(offs)
            owner = np.repeat(np.arange(len(n)), n)
            digest = _digests(value, offs)
            rank_of = order.value[_buckets(value)]
            by = np.argsort(owner * (int(rank_of.max(initial=0)) + 1) + rank_of, kind="stable")   # values ascend already
            keep = n - -(-num * n // den) + 1
            keep[n == 0] = 0
            rank = np.arange(len(value)) - np.repeat(offs[:-1], n)
            first = by[rank < keep[owner]]
            hist = np.bincount(owner * CLASSES + (value & np.uint64(CLASSES - 1)).astype(np.int64), minlength=len(n) * CLASSES)
            hist = np.minimum(hist, 255).astype(np.uint8).tobytes()
            yield pa.RecordBatch.from_arrays(
                [ids, k1, k2, pa.array(n), pa.array(digest.view(np.int64), mask=n == 0),
                 pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(keep)].astype(np.int32)), pa.array(value[first].view(np.int64))),
                 pa.array([hist[i * CLASSES:(i + 1) * CLASSES] for i in range(len(n))], pa.binary())],
                names=["id", "k1", "k2", "n", "node", "front", "hist"])

    described_as = f"id {kind}, k1 bigint, k2 bigint, n bigint, node bigint, front array<bigint>, hist binary"
    sets = materialize(texts.mapInArrow(described, described_as), "shingle-sets")
    # one row per distinct set, so that neither copies nor repeated ids come into the joins below
    hist = sets.where("n > 0").groupBy("node").agg(F.min("id").alias("first_id"), F.min("k1").alias("one"), F.min("n").alias("n"),
                                                   F.min("hist").alias("hist"), F.min("front").alias("front"))
    hist = materialize(hist, "set-histograms")
    posted = hist.select("node", F.col("n").cast("int").alias("n"), F.explode("front").alias("cell"))
    often = materialize(posted.groupBy("cell").agg(F.count("*").alias("m")).where("m > 1"), "shared-cells")
    inside = materialize(posted.join(often, "cell"), "cells")

    # every cell is first compared with one pivot of its own, its smallest set by digest
    pivot = materialize(inside.groupBy("cell").agg(F.min(F.struct("node", "n")).alias("p")), "cell-pivots")
    aimed = inside.join(pivot, "cell").select("cell", "m", F.col("p.node").alias("a"), F.col("node").alias("b"), F.col("p.n").alias("na"),
                                              F.col("n").alias("nb")).where("a <> b")
    aimed = materialize(aimed, "cell-stars")
    sizes_fit = (F.col("na") * den >= F.col("nb") * num) & (F.col("nb") * den >= F.col("na") * num)
    def side(name: str) -> DataFrame:
        return hist.select(F.col("node").alias(name), F.col("n").alias(f"n{name}"), F.col("hist").alias(f"h{name}"))

    def bounded(batches):
        for b in batches:
            if not b.num_rows:
                continue
            ha, hb = (np.frombuffer(b"".join(b.column(k).to_pylist()), np.uint8).reshape(-1, CLASSES).astype(np.int16) for k in (4, 5))
            n = b.column(2).to_numpy() + b.column(3).to_numpy()
            apart = np.abs(ha - hb).sum(axis=1)          # at most |a \ b| + |b \ a|
            yield pa.RecordBatch.from_arrays(b.columns[:2], names=["a", "b"]).filter(pa.array((den + num) * apart <= (den - num) * n))

    def close(pairs: DataFrame, label: str) -> DataFrame:
        """The pairs (a, b) that their histograms allow to link."""
        return materialize(pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "na", "nb", "ha", "hb")
                           .mapInArrow(bounded, "a bigint, b bigint"), label)

    def listed(batches):
        known = WordHashes()
        for _, rows in _texts(batches, 0):
            value, offs = shingle_sets(rows, known, size)
            yield pa.RecordBatch.from_arrays(
                [pa.array(_digests(value, offs).view(np.int64)),
                 pa.ListArray.from_arrays(pa.array(offs.astype(np.int32)), pa.array(value.view(np.int64)))], names=["node", "set"])

    def compared(batches):
        """Rows sorted by (a, part), the set of ``a`` itself first: links of a with the sets that follow."""
        own = np.zeros(0, np.uint64)
        for batch in batches:
            ok = []
            for mine, v in zip(batch.column(3).to_pylist(), _lists(batch.column(4))):
                v = v.view(np.uint64)                     # hashes ascend as unsigned numbers
                if mine:
                    own = v.copy()
                    ok.append(False)
                else:
                    at = np.minimum(np.searchsorted(own, v), len(own) - 1)
                    ok.append(bool(linked(int((own[at] == v).sum()), len(own), len(v), num, den)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2)], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    def regions(batches):
        for g in stream_groups(batches, ["cell", "i", "j"]):
            if g.num_rows < 2:
                continue
            lists = g.column("set").combine_chunks()
            node = g.column("node").to_numpy()
            offs = lists.offsets.to_numpy().astype(np.int64)
            values = lists.values.to_numpy()[offs[0]:offs[-1]].view(np.uint64)
            x, y = region_links(values, offs - offs[0], num, den)
            yield pa.RecordBatch.from_arrays([pa.array(node[x]), pa.array(node[y])], names=["a", "b"])

    def fetched(nodes: DataFrame, label: str) -> DataFrame:
        """(node, set) of the given sets, shingled again from a text that has each."""
        wanted = materialize(hist.join(nodes.distinct(), "node").select("node", "one"), f"{label}-wanted")
        rows = wanted.select(F.col("one").alias("k1")).distinct()
        full = texts.join(rows, "k1").select("text").mapInArrow(listed, "node bigint, set array<bigint>")
        return materialize(full.join(wanted.select("node"), "node").dropDuplicates(["node"]), label)      # a row may repeat

    def verified(near: DataFrame, label: str) -> DataFrame:
        """The pairs whose sets link. Pairs of one ``a`` are split into parts, each with a copy of its set."""
        full = fetched(near.select(F.explode(F.array("a", "b")).alias("node")), f"{label}-sets")
        many_of = materialize(near.groupBy("a").agg(F.ceil(F.count("*") / PART).alias("parts")), f"{label}-parts")
        parted = materialize(near.join(many_of, "a").select("a", F.pmod(F.xxhash64("b"), F.col("parts")).alias("part"), "b"), f"{label}-parted")
        rows = parted.join(full.withColumnRenamed("node", "b"), "b").select("a", "part", "b", F.lit(False).alias("own"), "set").union(
            parted.select("a", "part").distinct().join(full.withColumnRenamed("node", "a"), "a").select(
                "a", "part", F.col("a").alias("b"), F.lit(True).alias("own"), "set"))
        return materialize(rows.repartition("a", "part").sortWithinPartitions("a", "part", F.desc("own"))
                           .mapInArrow(compared, "a bigint, b bigint"), label)

    stars = verified(close(aimed.where(sizes_fit).select("a", "b").distinct(), "near-stars"), "star-links")
    # sets that link with their cell's pivot hang together: only pairs with one that does not are left
    hit = stars.withColumn("hit", F.lit(1))
    rest = aimed.where("m > 2").join(hit, ["a", "b"], "left").select("cell", "m", "a", F.col("b").alias("node"), F.col("nb").alias("n"),
                                                                     F.coalesce("hit", F.lit(0)).alias("hit"))
    open_ = materialize(rest.groupBy("cell").agg(F.min("hit").alias("all_hit")).where("all_hit = 0").select("cell"), "open-cells")
    rest = materialize(rest.join(open_, "cell"), "open-sets")
    few = rest.where(F.col("m") <= SMALL_CELL)
    x, y = (few.select("cell", F.col("node").alias(i), F.col("n").alias(f"n{i}"), F.col("hit").alias(f"h{i}")) for i in "ab")
    pairs = x.join(y, "cell").where("a < b and ha + hb < 2").where(sizes_fit).select("a", "b").distinct()
    links = stars.union(verified(close(pairs, "near-pairs"), "pair-links"))

    # large open cells are joined per pivot, as cells of one pivot hold mostly the same sets
    crowd = rest.where(F.col("m") > SMALL_CELL)
    crowd = materialize(crowd.select(F.col("a").alias("cell"), "node", "hit").union(
        crowd.select(F.col("a").alias("cell"), F.col("a").alias("node"), F.lit(1).alias("hit"))).distinct(), "open-groups")
    keys = ["cell", "i", "j"]

    def blocked(groups: DataFrame, label: str) -> DataFrame:
        """Members copied to every pair of their group's blocks (one block for groups of up to BLOCK)."""
        size_of = materialize(groups.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")), f"{label}-blocks")
        return (groups.join(size_of, "cell").withColumn("mine", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
                .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
                .withColumn("i", F.least("mine", "other")).withColumn("j", F.greatest("mine", "other")).drop("blocks", "mine", "other"))

    def partnered(batches):
        """Members that some other member, by sizes and histograms, may link with; not where both link with the pivot."""
        for g in stream_groups(batches, keys):
            n = g.column("n").to_numpy()
            by = np.argsort(n, kind="stable")
            n, hit = n[by], g.column("hit").to_numpy()[by]
            h = np.frombuffer(b"".join(g.column("hist").to_pylist()), np.uint8).reshape(-1, CLASSES)[by].astype(np.int16)
            ends = np.searchsorted(n, n * den // num, side="right")
            keep = np.zeros(len(n), bool)
            for i, hi in enumerate(ends.tolist()):
                for lo in range(i + 1, hi, 4_096):
                    to = min(hi, lo + 4_096)
                    ok = (den + num) * np.abs(h[lo:to] - h[i]).sum(axis=1) <= (den - num) * (n[lo:to] + n[i])
                    ok &= (hit[lo:to] == 0) | (hit[i] == 0)
                    if ok.any():
                        keep[i] = True
                        keep[lo:to] |= ok
            if keep.any():
                yield pa.RecordBatch.from_arrays([pa.array(g.column(c).to_numpy()[by][keep]) for c in ("cell", "node")], names=["cell", "node"])

    told = blocked(crowd, "open").join(hist.select("node", "n", "hist"), "node").select(*keys, "node", "hit", "n", "hist")
    groups = materialize(told.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(partnered, "cell bigint, node bigint").distinct(),
                         "mixed-groups")
    many = materialize(blocked(groups, "mixed").select(*keys, "node"), "large-cells")
    joined = (many.join(fetched(many.select("node"), "cell-sets-full"), "node").select(*keys, "node", "set").repartition(*keys)
              .sortWithinPartitions(*keys, "node").mapInArrow(regions, "a bigint, b bigint"))
    links = materialize(links.union(joined).distinct(), "set-links")
    comp = components(links)
    named = hist.select("node", "first_id").join(comp, "node", "left").select("node", "first_id", F.coalesce("component", "node").alias("component"))
    named = materialize(named, "set-components")
    least = materialize(named.groupBy("component").agg(F.min("first_id").alias("component_id")), "component-ids")
    named = materialize(named.join(least, "component").select("node", "component", "component_id"), "node-components")
    return materialize(sets.select("id", "k1", "k2", "n", "node"), "set-rows"), named
