"""Decontamination leaves no broadcast behind, sends no matrix inside a task's function, and sums matrices in one exchange."""

import os

import numpy as np
import pytest
from pyspark import SparkContext

from warband.llm import decontaminate as module
from warband.llm.decontaminate import decontaminate, summed


@pytest.fixture
def sent(monkeypatch):
    """What is broadcast during a test: (value, broadcast). Functions beyond Spark's threshold come as bytes."""
    seen, plain = [], SparkContext.broadcast

    def noted(self, value):
        seen.append((type(value), plain(self, value)))
        return seen[-1][1]

    monkeypatch.setattr(SparkContext, "broadcast", noted)
    return seen


def test_broadcasts_go_and_no_function_holds_a_matrix(spark, sent):
    rng = np.random.default_rng(5)
    items = [" ".join(f"term{i}x{k}" for k in rng.permutation(70)) for i in range(20)]       # 1,400 terms x 144: over 1 MB
    docs = [(i, f"own{i} words before {items[i]} and after") for i in range(0, 20, 2)] + [(100, "nothing of it"), (101, None), (None, "")]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    out = decontaminate(docs, spark.createDataFrame(list(enumerate(items)), "item_id long, text string"))
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in out.collect()) == [(False, 100), (False, 101), (True, 0)]
    assert any(kind is np.ndarray for kind, _ in sent)                  # the products ran
    assert [kind for kind, _ in sent if kind is bytes] == []
    assert [kind for kind, b in sent if os.path.exists(b._path)] == []


def test_matrices_are_summed_in_one_exchange(spark, monkeypatch):
    rng = np.random.default_rng(6)
    parts = [rng.standard_normal((module._SLICE + 30, 3)) for _ in range(4)]
    rows = [(int(s), bytearray(d)) for m in parts for s, d in zip(*(c.to_pylist() for c in module._sliced(m).columns))]
    plans, frame = [], type(spark.range(0))
    plain = frame.collect
    monkeypatch.setattr(frame, "collect", lambda self: (plans.append(self._jdf.queryExecution().toString()), plain(self))[1])
    got = summed(spark.createDataFrame(rows, "slice int, data binary"), parts[0].shape)
    assert np.allclose(got, sum(parts))
    assert plans[0].partition("Physical Plan")[2].count("Exchange hashpartitioning") == 1
