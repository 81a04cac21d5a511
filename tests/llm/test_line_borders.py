"""Passages of short lines beside frequent lines, and the plan of a hot line."""

import random

import pytest
from pyspark.sql import functions as F

from tests.test_plans import _final_plans, small_skew  # noqa: F401
from warband.llm import line_dedup


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_short_passages_beside_frequent_lines_go(spark, seed):
    """Of the words of repeated passages (over 50 words, lines of 5 to 11 words) beside different frequent lines nine tenths
    and more go with their second copy on; lines of one document stay."""
    rng = random.Random(seed)
    line = lambda n: " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(n))
    frequent = [line(rng.randint(1, 9)) for _ in range(12)]
    passages = []
    for _ in range(25):
        p = []
        while sum(len(x.split()) for x in p) <= 50:
            p.append(line(rng.randint(5, 11)))
        passages.append(p)
    bodies = [(k, p) for k, p in enumerate(passages) for _ in range(rng.randint(2, 5))]
    rng.shuffle(bodies)
    docs, own = [], {}
    for d, (k, p) in enumerate(bodies):
        alone = [line(rng.randint(5, 11)) for _ in range(3)]
        own[d] = alone
        sides = [rng.choice(frequent) for _ in range(4)]
        docs.append((d, "\n".join([alone[0], sides[0], *([sides[1]] * rng.randint(0, 1)), *p, sides[2], alone[1], sides[3], alone[2]])))
    got = {r.doc_id: r.text.split("\n") for r in line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    words = left = 0
    seen = set()
    for d, (k, p) in enumerate(bodies):
        assert set(own[d]) <= set(got[d])
        if k in seen:
            words += sum(len(x.split()) for x in p)
            left += sum(len(x.split()) for x in p if x in got[d])
        else:
            assert set(p) <= set(got[d])                # the first copy stays whole
        seen.add(k)
    assert left <= 0.1 * words


def test_a_hot_line_is_split(spark, small_skew, monkeypatch):  # noqa: F811
    plans = _final_plans(monkeypatch, line_dedup)
    n = 20_000
    docs = spark.range(n, numPartitions=8).select(F.col("id").alias("doc_id"), F.concat_ws(
        "\n", F.lit("a line that all hold"), F.sha1(F.col("id").cast("string")), F.sha1((F.col("id") % (n // 2)).cast("string"))).alias("text"))
    assert line_dedup.dedup_lines(docs).count() == n
    assert "skew=true" in plans["run-lines"]
