"""Line dedup, license scan, n-gram join and embedding dedup against SQL oracles and brute force."""

import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import warband.llm.ngram_join as N
from tests.conftest import SF01
from warband.llm import embedding_dedup, license_scan, line_dedup
from warband.llm.common import components, stream_groups
from warband.llm.embedding_dedup import near_duplicate_vectors, table_keys, table_layout
from warband.llm.shingle_sets import WordHashes, shingle_sets
from warband.llm.tables import table

_SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


def long_line(k, words=14):
    rng = random.Random(k)
    return " ".join(rng.choice("abcdefghij") * rng.randint(2, 6) + str(rng.randint(0, 999)) for _ in range(words))


def duck_rows(sql, **tables):
    con = duckdb.connect()
    for name, df in tables.items():
        con.register(f"{name}_rows", df)
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM {name}_rows")
    return con.execute(sql).fetchall()


def test_line_dedup_removes_passages_wherever_they_stand(spark):
    passage = [long_line(k, 20) for k in range(4)]
    short = [f"w{k} x{k} y{k} z{k} q{k}" for k in range(14)]           # 70 words in lines of 5
    docs = []
    for d in range(30):
        own = [long_line(1000 + d * 10 + k, 15) for k in range(4)]
        body = own[:1 + d % 3] + passage + own[1 + d % 3:] if d % 2 else own[:d % 4] + short + own[d % 4:]
        docs.append((d, "\n".join(body), own))
    df = spark.createDataFrame([(d, t) for d, t, _ in docs], "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(df).collect()}
    assert got[0] == docs[0][1] and got[1] == docs[1][1]
    for d, _, own in docs[2:]:
        left = got[d].split("\n")
        assert set(own) <= set(left) and not set(passage) & set(left)
        assert not set(short) & set(left)


def test_line_dedup_cases(spark):
    block = "\n".join(long_line(k) for k in range(3))
    rows = [(1, block, "a"), (2, block, None), (3, None, "c"), (4, "", "d"), (5, "short\nshort\nshort", "e"), (5, "short\nshort\nshort", "e"),
            (None, block, "f"), (7, "x\n" * 20_000, "g"), (8, block + "\nown line", "h"), (8, block + "\nown line", "h")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ls string").withColumn("lines_removed", F.lit("old"))
    got = line_dedup.dedup_lines(df)
    assert got.columns == ["doc_id", "text", "ls", "lines_removed"] and got.count() == len(rows)
    by = {r.doc_id: r for r in got.collect()}
    assert by[1].text == block and by[2].text == "" and by[2].lines_removed == 3 and by[None].text == ""
    assert by[3].text is None and by[4].text == "" and by[5].text == rows[4][1] and by[7].text == rows[7][1]
    assert by[8].text == "own line" and by[8].ls == "h"
    assert line_dedup.dedup_lines(df.limit(0)).count() == 0


def test_line_dedup_equals_sql(spark):
    docs = table(spark, SF01, "documents").select("doc_id", "text").where("doc_id < 400")
    pdf = docs.toPandas()
    got = sorted((r.doc_id, r.text, r.lines_removed) for r in line_dedup.dedup_lines(docs).collect())
    cols = "SELECT doc_id, text, lines_removed FROM (" + line_dedup.ORACLE_SQL + ")"
    assert got == sorted(duck_rows(cols, documents=pdf))
    assert sum(r[2] for r in got) > 0


def test_license_scan(spark):
    pad = " ".join(f"pad{k}" for k in range(40))
    mit, gpl = license_scan.TEMPLATES[1][1], license_scan.TEMPLATES[4][1]
    near = " ".join(w for k, w in enumerate(mit.split()) if k != 0)
    rows = [(1, f"{pad} {mit} {pad}"), (2, f"{pad}\n{gpl.upper()}\n{mit}"), (3, f"{near} {pad}"), (4, pad), (5, None), (6, ""), (7, "MIT License"),
            (8, " ".join(mit.split()[:9]) + pad), (9, gpl), (9, gpl), (None, gpl), (10, f"{pad} " * 500 + mit)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("m", F.lit(1))
    got = {(r.doc_id, r.template): r for r in license_scan.scan_licenses(docs).collect()}
    assert set(got) == {(1, 1), (2, 4), (2, 1), (3, 1), (9, 4), (None, 4), (10, 1)}
    assert got[(1, 1)].first_shingle == 40 and got[(1, 1)].containment == 1.0 and 0.8 <= got[(3, 1)].containment < 1
    pdf = docs.select("doc_id", "text").where("doc_id is not null").toPandas()
    want = {(r[0], r[1]): r for r in duck_rows("SELECT doc_id, template, license, containment, first_shingle, windows FROM ("
                                               + license_scan.oracle_sql() + ")", documents=pdf)}
    assert {k: tuple(v) for k, v in got.items() if k[0] is not None} == want
    assert license_scan.scan_licenses(docs.limit(0)).count() == 0


def brute_components(ids, sets, num=85, den=100):
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            inter = len(sets[i] & sets[j])
            if sets[i] and sets[j] and den * inter >= num * (len(sets[i]) + len(sets[j]) - inter):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [ids[find(i)] for i in range(len(ids))]


def word_set(text):
    w = _SPLIT.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i:i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)} if w else set()


def families(seed):
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(2000)]
    out = []
    for size in (1, 2, 5, 40, 60):
        base = [rng.choice(vocab) for _ in range(rng.choice([30, 80, 200]))]
        for _ in range(size):
            t = list(base)
            for _ in range(rng.randint(0, max(1, len(t) // 60))):
                t[rng.randrange(len(t))] = rng.choice(vocab)
            out.append(" ".join(t))
    common = " ".join(rng.choice(vocab) for _ in range(40))
    out += [common + " " + " ".join(rng.choice(vocab) for _ in range(rng.randint(1, 9))) for _ in range(50)]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("small_cell, block", [(128, 2048), (3, 2048), (2, 16)])
def test_ngram_components_equal_brute_force(spark, monkeypatch, small_cell, block):
    monkeypatch.setattr(N, "SMALL_CELL", small_cell)
    monkeypatch.setattr(N, "BLOCK", block)
    texts = families(small_cell)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in N.ngram_components(docs).collect()}
    sets = [word_set(t) for t in texts]
    want = brute_components(list(range(len(texts))), sets)
    assert got == {i: (len(sets[i]), want[i]) for i in range(len(texts))}
    assert len(set(want)) < len(want)


def test_ngram_cases(spark):
    a = "The quick brown fox jumps over the lazy dog again and again today"
    rows = [(1, a), (2, a.upper()), (3, None), (4, " \t\n"), (5, "two words"), (6, "TWO\nwords"), (6, "else entirely"), (None, a), (7, "É é"), (8, "é é"),
            (9, a + " x" * 30_000), (10, a), (10, a)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("node", F.lit("clash"))
    got = N.ngram_components(docs)
    assert got.columns == ["doc_id", "n_shingles", "component_id"] and got.count() == len(rows)
    by = {}
    for r in got.collect():
        by.setdefault(r.doc_id, []).append((r.n_shingles, r.component_id))
    assert by[1] == [(10, 1)] and by[2] == [(10, 1)] and by[10] == [(10, 1)] * 2 and by[None] == [(10, 1)]
    assert by[3] == [(0, 3)] and by[4] == [(0, 4)] and by[5] == [(1, 5)] and sorted(by[6])[0] == (1, 5) and by[7] == [(1, 7)] and by[8] == [(1, 8)]
    assert by[9][0][1] == 9
    assert N.ngram_components(docs.limit(0)).count() == 0


def test_region_links_keep_components():
    rng = np.random.default_rng(7)
    for _ in range(20):
        base = [rng.choice(10_000, 40, replace=False) for _ in range(4)]
        sets = []
        for _ in range(60):
            s = set(base[rng.integers(4)].tolist())
            for _ in range(rng.integers(0, 5)):
                s.discard(rng.choice(sorted(s)))
                s.add(int(rng.integers(20_000)))
            sets.append(s)
        values = np.concatenate([np.sort(np.array(sorted(s), np.uint64)) for s in sets])
        x, y = N.region_links(values, np.r_[0, np.cumsum([len(s) for s in sets])])
        root = list(range(60))

        def find(v):
            while root[v] != v:
                v = root[v]
            return v

        for i, j in zip(x, y):
            root[max(find(i), find(j))] = min(find(i), find(j))
        assert [find(v) for v in range(60)] == brute_components(list(range(60)), sets)


def test_shingle_hashes_follow_the_words():
    texts = ["a b c d e", "A B C D", "a b", None, "", "b a", "a b c d e"]
    value, offs = shingle_sets([t.encode() if t else t for t in texts], WordHashes())
    sets = [frozenset(value[i:j].tolist()) for i, j in zip(offs[:-1], offs[1:])]
    assert [len(s) for s in sets] == [2, 1, 1, 0, 0, 1, 2] and sets[1] < sets[0] == sets[6] and sets[2] != sets[5]


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, k) for k in range(101, 400)] + [(500, 500), (601, 600), (600, 601)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[k] for k in range(61)} == {0} and {got[k] for k in range(100, 400)} == {100} and got[601] == got[600] == 600
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_streamed_groups_cross_batches():
    import pyarrow as pa
    rng = np.random.default_rng(2)
    key = np.sort(rng.integers(0, 30, 500))
    cuts = np.unique(rng.integers(0, 500, 20))
    batches = [pa.RecordBatch.from_arrays([pa.array(k), pa.array(np.arange(len(k)))], names=["k", "v"])
               for k in np.split(key, cuts)]
    groups = list(stream_groups(batches, ["k"]))
    assert [g.column("k")[0].as_py() for g in groups] == sorted(set(key.tolist()))
    assert [g.num_rows for g in groups] == [int((key == k).sum()) for k in sorted(set(key.tolist()))]


def vectors(seed=1):
    rng = np.random.default_rng(seed)
    rows, n = [], 0
    for size in (1, 1, 3, 30, 60):
        c = rng.standard_normal(16)
        for _ in range(size):
            rows.append((n, (c + rng.standard_normal(16) * rng.choice([0.0, 0.05, 0.12])).astype(np.float32).tolist(), int(rng.integers(2))))
            n += 1
    return rows


@pytest.mark.parametrize("block", [1024, 8])
def test_embedding_links_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    rows = vectors()
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_duplicate_vectors(
        spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(5)).collect()}
    v = np.array([r[1] for r in rows], float)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    lab = np.array([r[2] for r in rows])
    link = (v @ v.T >= 0.98) & (lab[:, None] == lab) & ~np.eye(len(rows), dtype=bool)
    comp = list(range(len(rows)))
    for _ in range(len(rows)):
        comp = [min([comp[i]] + [comp[j] for j in np.flatnonzero(link[i])]) for i in range(len(rows))]
    wrong = sum(got[i] != (int(link[i].sum()), comp[i], comp[i] == i) for i in range(len(rows)))
    assert wrong <= 2 and link.sum() > 100              # each pair is missed with probability 1e-4 at most


def test_embedding_cases(spark):
    a = [1.0, 2.0, 3.0]
    rows = [(1, a, 1), (2, [2.0, 4.0, 6.0], 1), (3, a, 2), (4, a, None), (5, None, 1), (6, [0.0, 0.0, 0.0], 1), (7, [1.0, None, 3.0], 1),
            (8, [float("nan"), 2.0, 3.0], 1), (9, [float("inf"), 2.0, 3.0], 1), (10, a + [1.0], 1), (11, a, 1), (11, a, 1), (12, [], 1), (13, [-1.0, -2.0, -3.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("rep", F.lit(0))
    got = near_duplicate_vectors(df)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"] and got.count() == len(rows)
    by = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got.collect()}
    assert by[1] == (3, 1, True) and by[2] == (3, 1, False) and by[11] == (3, 1, False)
    for k in (3, 4, 5, 6, 7, 8, 9, 10, 12, 13):
        assert by[k] == (0, k, True)
    assert near_duplicate_vectors(df.limit(0)).count() == 0


def test_layout_misses_rarely():
    for n in (10, 10_000, 10**9):
        bits, tables = table_layout(n, 0.98)
        p = (1 - np.arccos(0.98) / np.pi) ** bits
        assert (1 - p) ** tables <= 1.01e-4
    rng = np.random.default_rng(1)
    x = rng.standard_normal((200, 64))
    y = x / np.linalg.norm(x, axis=1, keepdims=True) + rng.standard_normal((200, 64)) * 0.2 / 8
    assert (table_keys(x, 14, 20) == table_keys(y, 14, 20)).any(axis=1).mean() > 0.95
