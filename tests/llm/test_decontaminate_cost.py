"""Decontamination checks candidates where their texts are read, and its array forms equal the plain ones."""

import numpy as np
import pyarrow as pa

from tests.llm.test_corpus import lcs
from warband.llm import decontaminate as D


def test_no_text_is_shuffled(spark, monkeypatch):
    item = " ".join(f"word{k}" for k in range(30))
    docs = [(1, "before it " + item), (1, "before it " + item), (1, "another text " + item), (2, "nothing of it"), (3, None),
            (4, ""), (None, item), (None, item), (5, " ".join(f"word{k}" for k in range(20)) + " ends"), (6, item + " long" * 3_000 + " " + item)]
    plans, plain = {}, D.materialize

    def noted(df, label):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return plain(df, label)

    monkeypatch.setattr(D, "materialize", noted)
    monkeypatch.setattr(D, "MARKED_ROWS", 2)             # several slices in a task
    monkeypatch.setattr(D, "MARKED_CHARS", 400)
    bench = spark.createDataFrame([(0, item), (1, "none such"), (2, None), (3, "...")], "item_id long, text string")
    got = D.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), bench).select("doc_id", "item_id", "lcs", "answer")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [(1, 0, 1.0, True), (1, 0, 1.0, True), (None, 0, 1.0, True), (6, 0, 1.0, True)], key=str)
    assert plans and "Exchange" not in plans["leaks"] and "Sort" not in plans["leaks"]


def test_hits_are_the_words(spark):
    texts = ["", "  ", "One, two;three ONE", "\x00a\x85b c d eİ İ", "café CAFÉ \U0001f600 two", "-one--two-", "x" * 70_000 + " one"]
    terms = [b"one", b"two", "café".encode(), "İ".lower().encode(), b"a\xc2\x85b\xc2\xa0c\xe2\x80\x83d", "\U0001f600".encode()]
    want = [(i, p, terms.index(w)) for i, t in enumerate(texts) for p, w in enumerate(D.words_of(t)) if w in terms]
    assert len({t for _, _, t in want}) == len(terms)
    assert list(zip(*(x.tolist() for x in D.term_hits(texts, pa.array(terms, pa.string()))))) == want
    assert [len(x) for x in D.term_hits([], pa.array(terms, pa.string()))] == [0, 0, 0]
    assert [len(x) for x in D.term_hits(texts, pa.array([], pa.string()))] == [0, 0, 0]


def test_near_rows_by_brute_force(monkeypatch):
    rng = np.random.default_rng(8)
    monkeypatch.setattr(D, "SCORES_AT_ONCE", 1)          # many steps
    pos = [np.sort(rng.choice(900, rng.integers(0, 60), replace=False)) for _ in range(80)]
    term = [rng.integers(0, 50, len(p)) for p in pos]
    idf, basis, vectors = 1 + rng.random(40), rng.standard_normal((40, 6)), rng.standard_normal((9, 6))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    a = D.Passages.of(*D._joined(pos, term), idf)        # ten terms are only counted
    want, cells = set(), 0
    for d, (ps, ts) in enumerate(zip(pos, term)):
        for w in range(900 // D.STRIDE + 1):
            tf = np.bincount([t for p, t in zip(ps, ts) if t < 40 and w * D.STRIDE <= p < w * D.STRIDE + D.WINDOW], minlength=40)
            if tf.any():
                cells += 1
                z = np.where(tf, 1 + np.log(np.maximum(tf, 1)), 0) * idf @ basis
                want |= {(d, w, int(c)) for c in np.flatnonzero(vectors @ z / np.linalg.norm(z) >= D.COSINE)}
    row, c = a.near(basis, vectors)
    assert len(a.start) == cells and len(want) > 50
    assert {(int(a.doc[r]), int(a.win[r]), int(k)) for r, k in zip(row, c)} == want


def test_places_give_the_subsequence():
    rng = np.random.default_rng(9)
    for _ in range(50):
        a, b = (rng.integers(0, 6, rng.integers(1, 30)).tolist() for _ in range(2))
        assert D.lcs_length(a, b) == lcs(a, b)
