"""Density clustering on cosine distance inside candidate groups.

Points are distinct sequences with a weight (their number of identical copies) and a
sparse char-n-gram count vector. Exact DBSCAN semantics: ``y`` neighbours ``x`` iff
``1 − cos(x, y) ≤ eps`` (cosine rounded to 9 digits so the float edge is stable); ``x``
is a core iff the weighted number of its neighbours, itself included, is ≥
``min_samples``; cores that neighbour each other form one cluster; a non-core point
joins the cluster with the smallest label among the cores it neighbours, where a
cluster's label is its smallest core id (the sequential algorithm's numbering). Zero
vectors (texts shorter than n) neighbour nothing and are noise.

A group of up to ``task_points`` points is settled by one task: its vectors are shuffled once, and labels come
back. Small groups are packed into such tasks.

Most points of a larger group are settled against samples of it, chosen by a hash. A point with ``min_samples`` neighbours in a
sample is a core without looking further, and a core that neighbours a sampled core is in its cluster; cores of the first
sample are the first such. What is still open meets samples ``SAMPLE_GROWTH`` times as large, as long as rounds settle most of it.
Cores that two clusters share join them. Left open are the points without a known core beside them and those of all but
the group's largest cluster so far. Only pairs with an open point are looked at below, so this is exact, whatever the samples,
and where one cluster holds most of a dense group the work follows its number of points, not its square.

Open points meet the others in *slots*. With ``t = 1 − eps``, a point's prefix are its rarest grams (in one
order of all the group's grams) up to where the norm of the rest falls below ``t``: two points that share no
gram of both prefixes have all their common grams in the rest of one of them, so their cosine is below ``t``
(prefix filtering for unit vectors, as in Bayardo, Ma and Srikant, WWW 2007). The slots are the lists of an
inverted index over the prefixes, and a pair is looked at in its first common list only. Where that would copy
points more often than one slot for the whole group (few grams, which all points hold), the group is one slot;
the two costs are counted, not guessed. A slot is cut into blocks of ``block_size`` points by a hash, and a block
pair is one task's dense product over the grams that two of its points share.

Two passes over the slots: neighbour counts (cores), then a spanning star forest of each block pair's core–core
links together with one link from each non-core point to each local tree it touches; settled cores take part under their
cluster's node. Nothing emitted is quadratic. Components of the forest are found by min-label propagation with pointer jumping, each round written
to the checkpoint folder; a border point takes the smallest label its links lead to.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from warband.session import checkpoint_dir, materialize, materialize_observed

TASK_POINTS = 2_048
SAMPLE_POINTS = 512          # of the first round
SAMPLE_GROWTH = 16
INDEX_COPIES = 4             # copies per point up to which no index is counted
GRAMS_AT_ONCE = 4_096        # columns of a dense product
NO_LABEL = np.iinfo(np.int64).max


def _cosines(x: pd.DataFrame, y: pd.DataFrame) -> np.ndarray:
    """Cosines of the rows of ``x`` with those of ``y``, 0 where a vector is empty, rounded to 9 digits."""
    both = [x] if x is y else [x, y]
    grams = np.concatenate([g for p in both for g in p["grams"]] or [np.zeros(0)])
    counts = np.concatenate([c for p in both for c in p["cnts"]] or [np.zeros(0)]).astype(float)
    row = np.repeat(np.arange(sum(map(len, both))), [len(g) for p in both for g in p["grams"]])
    norm = np.sqrt(np.bincount(row, counts * counts, sum(map(len, both))))
    _, gram, seen = np.unique(grams, return_inverse=True, return_counts=True)
    number = np.cumsum(seen > 1) - 1                # grams of one row only count in its norm
    shared = seen[gram] > 1
    row, gram, counts = row[shared], number[gram[shared]], counts[shared]
    by = np.argsort(gram, kind="stable")
    row, gram, counts = row[by], gram[by], counts[by]
    n, width = len(x), int(gram[-1]) + 1 if len(gram) else 0
    dots = np.zeros((n, len(y)))
    for lo in range(0, width, GRAMS_AT_ONCE):
        part = slice(*np.searchsorted(gram, [lo, lo + GRAMS_AT_ONCE]))
        dense = np.zeros((len(norm), min(GRAMS_AT_ONCE, width - lo)))
        dense[row[part], gram[part] - lo] = counts[part]
        dots += dense[:n] @ (dense[:n] if x is y else dense[n:]).T
    if x is y:
        np.fill_diagonal(dots, norm * norm)
    scale = np.outer(norm[:n], norm if x is y else norm[n:])
    return np.round(np.divide(dots, scale, out=np.zeros_like(dots), where=scale > 0), 9)


def _near(x: pd.DataFrame, y: pd.DataFrame, eps: float) -> np.ndarray:
    known = lambda p: p["grams"].map(len).to_numpy() > 0
    return (_cosines(x, y) >= round(1.0 - eps, 9)) & known(x)[:, None] & known(y)


def _meet(x: pd.DataFrame, y: pd.DataFrame, eps: float) -> np.ndarray:
    """Which rows are neighbours; of points in a list of the index those that share no earlier list."""
    near = _near(x, y, eps)
    if x["pos"].any() and y["pos"].any():
        cut = lambda p: pd.DataFrame({"grams": [a[:k] for a, k in zip(p["pre"], p["pos"])],
                                      "cnts": [np.ones(k) for k in p["pos"]]})
        left = cut(x)
        near &= ~(_cosines(left, left if x is y else cut(y)) > 0)
    return near


def _low_labels(near: np.ndarray, x: np.ndarray, y: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Smallest id of each point's component under the links ``near`` between ids ``x`` and ``y``."""
    a, b = np.nonzero(near)
    ids, at = np.unique(x if same else np.concatenate([x, y]), return_inverse=True)
    a, b = at[a], at[b] if same else at[len(x) + b]
    low = np.arange(len(ids))
    while True:
        new = low.copy()
        np.minimum.at(new, a, low[b])
        np.minimum.at(new, b, low[a])
        new = new[new]
        if (new == low).all():
            break
        low = new
    lab = ids[low[at]]
    return (lab, lab) if same else (lab[:len(x)], lab[len(x):])


def _frame(**columns) -> pd.DataFrame:
    return pd.DataFrame({k: np.asarray(v, np.int64) for k, v in columns.items()})


def _settled(eps: float, min_samples: int):
    """All labels of every whole group of one task."""
    def one(g: int, p: pd.DataFrame) -> pd.DataFrame:
        p = p.reset_index(drop=True)
        sid, weight = p["sid"].to_numpy(np.int64), p["weight"].to_numpy()
        near = (_cosines(p, p) >= round(1.0 - eps, 9)) & np.logical_and.outer(*[p["grams"].map(len).to_numpy() > 0] * 2)
        core = near @ weight >= min_samples
        label = np.full(len(p), NO_LABEL)
        label[core], _ = _low_labels(near[np.ix_(core, core)], sid[core], sid[core], True)
        edge = np.where(near & core, label, NO_LABEL).min(axis=1, initial=NO_LABEL)
        label = np.where(core, label, edge)
        kept = label < NO_LABEL
        return _frame(g=np.full(kept.sum(), g), sid=sid[kept], label=label[kept])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.concat([one(g, part) for g, part in pdf.groupby("g", sort=False)], ignore_index=True)
    return run


def _sides(pdf: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
    i, j = pdf["bi"].iat[0], pdf["bj"].iat[0]
    x = pdf[pdf["blk"] == i].reset_index(drop=True)
    return x, x if i == j else pdf[pdf["blk"] == j].reset_index(drop=True)


def _first_cores(eps: float, min_samples: int):
    """Cores among a group's sample alone, under the smallest id they are linked to."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        p = pdf.reset_index(drop=True)
        near = _near(p, p, eps)
        core = near @ p["weight"].to_numpy() >= min_samples
        sid = p["sid"].to_numpy(np.int64)[core]
        node, _ = _low_labels(near[np.ix_(core, core)], sid, sid, True)
        return _frame(g=np.full(len(sid), p["g"].iat[0]), sid=sid, node=node)
    return run


def _attached(eps: float, min_samples: int):
    """Points that the sampled ones show to be cores, with a cluster beside them; clusters that meet in one of them."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        x, y = (pdf[pdf["sampled"] == v].reset_index(drop=True) for v in (False, True))
        near, g = _near(x, y, eps), pdf["g"].iat[0]
        sx, sy, weight = x["sid"].to_numpy(np.int64), y["sid"].to_numpy(np.int64), y["weight"].to_numpy()
        others = near @ weight - (near & (sx[:, None] == sy)) @ weight
        known = y["node"].notna().to_numpy()
        at = near[:, known] & (others + x["weight"].to_numpy() >= min_samples)[:, None]
        got, node = at.any(axis=1), y["node"][known].to_numpy(np.int64)
        at, sx = at[got], sx[got]
        nodes, place = np.unique(node, return_inverse=True)
        touched = np.zeros((len(sx), len(nodes)), bool)
        for k in range(len(nodes)):
            touched[:, k] = at[:, place == k].any(axis=1)
        first = nodes[touched.argmax(axis=1)] if len(nodes) else np.zeros(0, np.int64)
        _, low = _low_labels(touched, first, nodes, False)
        return pd.concat([_frame(g=np.full(len(sx), g), u=sx, v=first, point=np.ones(len(sx))),
                          _frame(g=np.full(len(nodes), g), u=nodes, v=low, point=np.zeros(len(nodes)))], ignore_index=True)
    return run


def _counted(eps: float):
    """Weighted neighbour counts of a block pair's points that are not known as cores."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        x, y = _sides(pdf)
        near, g = _meet(x, y, eps), pdf["g"].iat[0]
        parts = [(x, near @ y["weight"].to_numpy())] + ([] if x is y else [(y, near.T @ x["weight"].to_numpy())])
        open_ = [(p["sid"][~p["core"].to_numpy(bool)], n[~p["core"].to_numpy(bool)]) for p, n in parts]
        return pd.concat([_frame(g=np.full(len(s), g), sid=s, n=n) for s, n in open_], ignore_index=True)
    return run


def _linked(eps: float):
    """Links of a block pair's nodes: cores to the smallest of their local tree, others to every local tree they touch."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        x, y = _sides(pdf)
        near, g = _meet(x, y, eps), pdf["g"].iat[0]
        cx, cy, sx, sy = x["core"].to_numpy(bool), y["core"].to_numpy(bool), x["node"].to_numpy(np.int64), y["node"].to_numpy(np.int64)
        lx, ly = _low_labels(near & cx[:, None] & cy, sx, sy, x is y)
        a, b = np.nonzero(near & ~cx[:, None] & cy)
        parts = [(sx[cx], lx[cx], 1), (sx[a], ly[b], 0)]
        if x is not y:
            b, a = np.nonzero(near & cx[:, None] & ~cy)
            parts += [(sy[cy], ly[cy], 1), (sy[a], lx[b], 0)]
        out = pd.concat([_frame(g=np.full(len(u), g), u=u, v=v, core=np.full(len(u), c)) for u, v, c in parts], ignore_index=True)
        return out[out["u"] != out["v"]].drop_duplicates()
    return run


def components(edges: DataFrame, nodes: DataFrame, max_rounds: int | None = None) -> DataFrame:
    """(g, sid, label): smallest node id of each connected component, per group.

    Labels only decrease, so the propagation ends; pointer jumping shortens chains each round.
    ``max_rounds`` is an optional guard, none by default.
    """
    checkpoint_dir(nodes.sparkSession)
    und = edges.select("g", "u", "v").unionByName(edges.select("g", F.col("v").alias("u"), F.col("u").alias("v")))
    und = materialize(und, "cc-edges")
    labels = materialize(nodes.select("g", "sid", F.col("sid").alias("label")), "cc-labels")
    rounds = 0
    while True:
        rounds += 1
        if max_rounds is not None and rounds > max_rounds:
            raise RuntimeError(f"components did not settle in {max_rounds} rounds")
        nbr = (und.join(labels.select("g", F.col("sid").alias("v"), F.col("label").alias("_l")), ["g", "v"])
               .groupBy("g", "u").agg(F.min("_l").alias("_nl")))
        stepped = (labels.join(nbr.withColumnRenamed("u", "sid"), ["g", "sid"], "left")
                   .select("g", "sid", F.col("label").alias("_old"),
                           F.least("label", F.coalesce("_nl", "label")).alias("label")))
        jumped = (stepped.join(stepped.select("g", F.col("sid").alias("label"), F.col("label").alias("_j")),
                               ["g", "label"], "left")
                  .select("g", "sid", "_old", F.least("label", F.coalesce("_j", "label")).alias("label")))
        labels, m = materialize_observed(jumped, "cc-labels", changed=F.count_if(F.col("label") != F.col("_old")))
        labels = labels.drop("_old")
        if m["changed"] == 0:
            return labels


def _prefixes(points: DataFrame, least: float) -> DataFrame:
    """(g, sid, pre): each point's rarest grams up to where the norm of the rest is below ``least`` of the whole."""
    entries = points.select("g", "sid", F.explode(F.arrays_zip("grams", "cnts")).alias("e")).select("g", "sid", "e.grams", "e.cnts")
    often = materialize(entries.groupBy("g", "grams").agg(F.count("*").alias("df")), "gram-counts")
    vectors = (entries.join(often, ["g", "grams"]).groupBy("g", "sid")          # a list is as long as its text at most
               .agg(F.array_sort(F.collect_list(F.struct("df", "grams", "cnts"))).alias("es")))
    squared = F.transform("es", lambda e: e["cnts"].cast("double") * e["cnts"])
    total = F.aggregate(squared, F.lit(0.0), lambda s, c: s + c)
    state = F.struct(F.lit(0.0).alias("s"), F.lit(0).alias("k"))
    rest = F.aggregate(F.reverse(squared), state, lambda st, c: F.struct(
        (st["s"] + c).alias("s"), F.when(st["s"] + c < F.lit(least * least) * total, st["k"] + 1).otherwise(st["k"]).alias("k")))
    return vectors.select("g", "sid", F.transform(F.slice("es", F.lit(1), F.size("es") - rest["k"]), lambda e: e["grams"]).alias("pre"))


def slots_of(points: DataFrame, sizes: DataFrame, eps: float, block_size: int) -> DataFrame:
    """(g, sid, slot, pos, pre, blk, nb, mine, nbo): where the points of large groups meet, stored.

    ``slot`` is the list's gram, or null for the one slot of a group whose index would make more copies;
    ``pre[:pos]`` are the point's lists before this one. Only pairs with a point that is ``open`` (all, without that column)
    are looked for: a slot's open points fill its first ``nbo`` blocks, the others the rest of ``nb``; ``mine`` are the blocks
    that a point meets."""
    if "open" not in points.columns:
        points = points.withColumn("open", F.lit(True))
    parts = lambda n: F.ceil(n / F.lit(block_size)).cast("int")
    nbo = parts(F.col("no"))
    nb = nbo + parts(F.col("n") - F.col("no"))
    copies = F.col("no") * nb + (F.col("n") - F.col("no")) * nbo
    opened = materialize(points.groupBy("g").agg(F.count_if("open").alias("no")), "open-counts")
    whole = points.join(sizes, "g").join(opened, "g").select("g", "sid", "open", "n", "no")
    many = sizes.join(opened, "g").where(copies > INDEX_COPIES * F.col("n"))     # others: cheaper than counting an index's lists
    gram_type = points.schema["grams"].dataType
    empty = F.array().cast(gram_type)
    h = F.xxhash64("sid")
    block = F.when(F.col("open"), F.pmod(h, F.col("nbo").cast("long"))).otherwise(
        F.col("nbo") + F.pmod(h, (F.col("nb") - F.col("nbo")).cast("long"))).cast("int").alias("blk")
    meets = ["nb", F.when(F.col("open"), F.col("nb")).otherwise(F.col("nbo")).alias("mine"), "nbo"]
    if round(1.0 - eps, 9) > 1e-6:
        listable = points.join(many.select("g"), "g", "left_semi")
        pre = materialize(_prefixes(listable, round(1.0 - eps, 9) - 1e-8).join(points.select("g", "sid", "open"), ["g", "sid"]), "prefixes")
        posts = pre.select("g", "sid", "open", "pre", F.posexplode("pre").alias("pos", "slot"))
        lists = materialize(posts.groupBy("g", "slot").agg(F.count("*").alias("n"), F.count_if("open").alias("no")), "index-lists")
        cost = lists.groupBy("g").agg(F.sum(copies).alias("index_copies"))
        plain = many.select("g", copies.alias("copies"))
        indexed = materialize(cost.join(plain, "g").where("index_copies < copies").select("g"), "indexed-groups")
        listed = (posts.join(indexed, "g", "left_semi").join(lists, ["g", "slot"])
                  .where("no > 0 and (n > 1 or pos = 0)")        # a point alone in its list meets itself in its first one
                  .withColumn("nbo", nbo).withColumn("nb", nb).select("g", "sid", "slot", "pos", "pre", block, *meets))
        whole = whole.join(indexed, "g", "left_anti")
    one = whole.where("no > 0").withColumn("nbo", nbo).withColumn("nb", nb).select(
        "g", "sid", F.lit(None).cast(gram_type.elementType).alias("slot"), F.lit(0).alias("pos"), empty.alias("pre"), block, *meets)
    return materialize(one if round(1.0 - eps, 9) <= 1e-6 else one.unionByName(listed), "slots")


def _block_pairs(slots: DataFrame, points: DataFrame):
    """Points in every block pair of their slots, grouped by block pair. The copies exist in the shuffle only."""
    rows = (slots.join(points, ["g", "sid"]).withColumn("k", F.explode(F.sequence(F.lit(0), F.col("mine") - 1)))
            .withColumn("bi", F.least("blk", "k")).withColumn("bj", F.greatest("blk", "k")).drop("k", "nb", "mine", "nbo"))
    return rows.groupBy("g", "slot", "bi", "bj")


def _sample_rounds(points: DataFrame, eps: float, min_samples: int, sample_points: int) -> tuple[DataFrame, DataFrame]:
    """(g, sid, node) cores with a cluster beside them and (g, u, v) links of such nodes, from ``points`` with group sizes ``n``."""
    cells = lambda n: F.ceil(n / F.lit(TASK_POINTS)).cast("int")
    cell = lambda n: F.pmod(F.xxhash64("sid", F.lit(2)), n.cast("long")).cast("int")
    chosen = lambda m: points.where(F.pmod(F.xxhash64("sid", F.lit(1)), F.ceil(F.col("n") / F.lit(m)).cast("long")) == 0)
    known = materialize(chosen(sample_points).groupBy("g").applyInPandas(_first_cores(eps, min_samples), "g long, sid long, node long"),
                        "first-cores")
    settled, links, m, before = None, [], sample_points, None
    while True:
        rest = points if settled is None else points.join(settled.select("g", "sid"), ["g", "sid"], "left_anti")
        counts, o = materialize_observed(rest.groupBy("g").agg(F.count("*").alias("no"), F.max("n").alias("n")), "open-counts",
                                         points=F.sum("no"), most=F.max("n"))
        if not o["points"] or before is not None and (2 * o["points"] > before or m // SAMPLE_GROWTH >= o["most"]):
            break
        before = o["points"]
        sizes = counts.select("g", cells(F.col("no")).alias("nx"), cells(F.least(F.lit(m), F.col("n"))).alias("ns"))
        cols = ["g", "sid", "weight", "grams", "cnts"]
        x = (rest.select(*cols).join(sizes, "g").withColumn("i", cell(F.col("nx"))).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("ns") - 1)))
             .select(*cols, F.lit(None).cast("long").alias("node"), F.lit(False).alias("sampled"), "i", "j"))
        y = (chosen(m).select(*cols).join(sizes, "g").join(known, ["g", "sid"], "left")
             .withColumn("j", cell(F.col("ns"))).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("nx") - 1)))
             .select(*cols, "node", F.lit(True).alias("sampled"), "i", "j"))
        found = materialize(x.union(y).groupBy("g", "i", "j").applyInPandas(
            _attached(eps, min_samples), "g long, u long, v long, point long"), "attached")
        # a point has one row per cell of the sample: few
        points_found = materialize(found.where("point = 1").groupBy("g", F.col("u").alias("sid")).agg(
            F.min("v").alias("node"), F.collect_set("v").alias("nodes")), "attached-points")
        links.append(found.where("point = 0 and u <> v").select("g", "u", "v").distinct())
        links.append(points_found.select("g", F.col("node").alias("u"), F.explode("nodes").alias("v")).where("u <> v").distinct())
        new = points_found.select("g", "sid", "node")
        settled = materialize(new if settled is None else settled.unionByName(new), "settled-cores")
        known, m = settled, m * SAMPLE_GROWTH
    for part in links[1:]:
        links[0] = links[0].unionByName(part)
    return settled, links[0].distinct()


def _large_groups(points: DataFrame, sizes: DataFrame, eps: float, min_samples: int, block_size: int, sample_points: int) -> DataFrame:
    points = materialize(points.join(sizes, "g"), "large-groups")
    settled, links = _sample_rounds(points, eps, min_samples, sample_points)
    roots = components(links, settled.select("g", F.col("node").alias("sid")).distinct())
    settled = materialize(settled.join(roots.select("g", F.col("sid").alias("node"), "label"), ["g", "node"])
                          .select("g", "sid", F.col("label").alias("root")), "rooted-cores")
    main = (settled.groupBy("g", "root").agg(F.count("*").alias("k")).groupBy("g")
            .agg(F.max(F.struct("k", "root")).alias("_m")).select("g", F.col("_m.root").alias("main")))
    points, o = materialize_observed(
        points.drop("n").join(settled, ["g", "sid"], "left").join(main, "g", "left").select(
            "g", "sid", "weight", "grams", "cnts", F.col("root").isNotNull().alias("core"), F.coalesce("root", "sid").alias("node"),
            (F.col("root").isNull() | (F.col("root") != F.col("main"))).alias("open")), "judged-points", open=F.count_if("open"))
    if not o["open"]:
        return points.withColumn("label", F.col("node")).groupBy("g", "label").agg(F.min("sid").alias("low")).join(
            points.select("g", "sid", F.col("node").alias("label")), ["g", "label"]).select("g", "sid", F.col("low").alias("label"))
    slots = slots_of(points, sizes, eps, block_size)
    rows = points.drop("open")
    counts = _block_pairs(slots, rows).applyInPandas(_counted(eps), "g long, sid long, n long").groupBy("g", "sid").agg(F.sum("n").alias("n"))
    flags = materialize(counts.where(F.col("n") >= min_samples).select("g", "sid", F.lit(True).alias("found")), "dbscan-cores")
    rows = materialize(rows.join(flags, ["g", "sid"], "left").withColumn("core", F.col("core") | F.coalesce("found", F.lit(False)))
                       .drop("found"), "judged-points")
    links = materialize(_block_pairs(slots, rows).applyInPandas(_linked(eps), "g long, u long, v long, core long").distinct(), "dbscan-links")
    cores = rows.where("core").select("g", "sid", "node")
    trees = components(links.where("core = 1").select("g", "u", "v"), cores.select("g", F.col("node").alias("sid")).distinct())
    cores = materialize(cores.join(trees.select("g", F.col("sid").alias("node"), F.col("label").alias("tree")), ["g", "node"]), "cores")
    named = materialize(cores.groupBy("g", "tree").agg(F.min("sid").alias("label")), "cluster-names")
    to = cores.select("g", F.col("node").alias("v"), "tree").distinct().join(named, ["g", "tree"]).select("g", "v", "label")
    borders = (links.where("core = 0").join(to, ["g", "v"]).groupBy("g", F.col("u").alias("sid")).agg(F.min("label").alias("label")))
    return cores.join(named, ["g", "tree"]).select("g", "sid", "label").unionByName(borders)


def dbscan(members: DataFrame, points: DataFrame, eps: float, min_samples: int,
           block_size: int = 512, task_points: int = TASK_POINTS, sample_points: int = SAMPLE_POINTS) -> DataFrame:
    """Cluster labels per (g, sid); noise points are absent.

    ``members``: (g, sid) group membership. ``points``: (sid, weight, grams, cnts) with
    ``grams``/``cnts`` the parallel arrays of a point's n-gram counts. Groups of fewer points than
    ``min_samples`` in weight hold no core and are left out before any vector moves.
    """
    checkpoint_dir(members.sparkSession)
    pts = points.select("sid", "weight", "grams", "cnts")
    heavy = members.select("g", "sid").join(points.select("sid", "weight"), "sid").groupBy("g").agg(
        F.count("*").alias("n"), F.sum("weight").alias("w")).where(F.col("w") >= min_samples).select("g", "n")
    sizes, m = materialize_observed(heavy, "group-sizes", small=F.sum(F.when(F.col("n") <= task_points, F.col("n"))),
                                    large=F.count_if(F.col("n") > task_points))
    bins = max(1, -(-(m["small"] or 0) // task_points))
    rows = members.select("g", "sid").join(sizes, "g").join(pts, "sid")
    small = rows.where(F.col("n") <= task_points).withColumn("bin", F.pmod(F.xxhash64("g"), F.lit(bins))).drop("n")
    out = small.groupBy("bin").applyInPandas(_settled(eps, min_samples), "g long, sid long, label long")
    if m["large"]:
        large = sizes.where(F.col("n") > task_points)
        out = out.unionByName(_large_groups(rows.where(F.col("n") > task_points).drop("n"), large, eps, min_samples, block_size, sample_points))
    return out
