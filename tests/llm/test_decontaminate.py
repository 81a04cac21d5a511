"""Decontamination candidates: what the latent basis cannot see is found by counts."""

import random

import numpy as np

from tests.llm.test_corpus import lcs
from warband.llm import decontaminate as D


def test_frequent_item_among_rare_terms_is_found(spark):
    rng = random.Random(4)
    item = " ".join(f"often{k}" for k in range(20))
    others = [" ".join(f"rare{i}x{k}" for k in range(40)) for i in range(30)]
    docs = [(k, f"intro{k} " + item + f" outro{k}" if k % 3 == 0 else f"plain text {k} of its own") for k in range(600)]
    for d in range(20):                      # the item word for word, in a window full of rare words of other items
        pick = rng.sample([w for o in others for w in o.split()], 44)
        docs.append((1000 + d, " ".join(pick[:22]) + " " + item + " " + " ".join(pick[22:])))
    bench = spark.createDataFrame([(0, item)] + [(k + 1, o) for k, o in enumerate(others)], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in D.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()}
    assert got == {(d, 0) for d, t in docs if item in t}


def test_counts_miss_no_leak():
    rng = np.random.default_rng(6)
    vocab = [f"w{k}".encode() for k in range(400)]
    words = [[vocab[k] for k in rng.integers(0, 400, n)] for n in (1, 4, 15, 33, 40, 64, 150, 700)]
    answers = [ws[-4:] for ws in words]
    counted = {}
    for ws in words:                         # all words of some items, the least share of others
        for w in sorted(set(ws))[:len(set(ws)) * 3 // 4 + 1]:
            counted.setdefault(w, len(counted))
    docs = []
    for _ in range(60):
        doc = [vocab[k] for k in rng.integers(0, 400, rng.integers(0, 2_500))]
        ws = words[rng.integers(len(words))]
        part = [w if rng.random() > 0.3 else b"other" for w in ws]
        at = rng.integers(0, len(doc) + 1)
        docs.append(doc[:at] + part + doc[at:])
    hits = [[(p, counted[w]) for p, w in enumerate(d) if w in counted] for d in docs]
    got = D.Counts(words, answers, counted).windows([np.array([p for p, _ in h], np.int64) for h in hits],
                                                    [np.array([t for _, t in h], np.int64) for h in hits])
    assert len(got) == len({tuple(r) for r in got.tolist()})
    found, leaks = {(d, i, w) for d, i, w in got.tolist()}, 0
    for d, doc in enumerate(docs):
        for i, ws in enumerate(words):
            for w in range(-(-len(doc) // D.STRIDE)):
                region = doc[max(0, w * D.STRIDE - len(ws)):w * D.STRIDE + D.WINDOW + len(ws)]
                if len(ws) > 1 and D.lcs_length(ws, region) / len(ws) >= D.PARAPHRASE:
                    leaks += 1
                    assert (d, i, w) in found
    assert leaks > 50 and lcs(words[1], docs[0]) <= 4


def test_parts_keep_the_rank_above_the_windows():
    rows = [(k, " ".join(f"a{j}" for j in range(40))) for k in range(400)] + [(400, "b " * 40_000), (401, "c")]
    parts = D.parts_of(rows)
    assert [r for p in parts for r in p] == rows and D.parts_of([]) == [[]]
    for p in parts:
        windows = sum(len(D.Passages([np.arange(len(t.split()))], [np.zeros(len(t.split()), np.int64)], np.ones(1)).start) for _, t in p)
        assert windows + D.MIN_RANK // 2 <= D.MAX_RANK or len(p) == 1
