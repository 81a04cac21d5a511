"""Language ID and toxicity: held-out accuracy and defined cases."""

import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF01
from warband.llm.common import bounded_sample, held_out
from warband.llm.language_id import LanguageModel, fit_languages, ngram_buckets, predict_languages
from warband.llm.queries import op5_language_id, op9_toxicity
from warband.llm.tables import table
from warband.llm.toxicity import FeatureIndex, fit_nnpu, fit_toxicity, score_toxicity, word_features


def test_language_accuracy(spark):
    got = op5_language_id(spark, SF01).toPandas().merge(table(spark, SF01, "documents").select("doc_id", "lang").toPandas(), on="doc_id")
    test = got[got.held_out]
    assert len(got) == 1000 and 100 < len(test) < 300
    assert (test.lang_pred == test.lang).mean() > 0.98
    assert got.score.between(0, 1).all()


def test_language_cases(spark):
    rows = [(i, "the cat and the dog", "en") for i in range(8)] + [(10 + i, "der hund und die katze", "de") for i in range(8)]
    docs = spark.createDataFrame([*rows, (30, None, None), (31, "", "en"), (32, "123 --- !!", None), (33, "the dog", None),
                                  (33, "the dog", None), (34, "die katze " * 20_000, None)], "doc_id long, text string, lang string")
    docs = docs.withColumn("lang_pred", F.lit("old"))
    model = fit_languages(docs, F.lit(True))
    got = predict_languages(docs, model)
    assert got.columns == ["doc_id", "text", "lang", "lang_pred", "lang_score"]
    by = {r.doc_id: r for r in got.collect()}
    assert {by[k].lang_pred for k in (30, 31, 32)} == {"und"} and by[30].lang_score == 0
    assert by[33].lang_pred == "en" and by[34].lang_pred == "de" and got.count() == 22
    empty = docs.limit(0)
    assert predict_languages(empty, fit_languages(empty, F.lit(True))).count() == 0
    assert LanguageModel([], np.zeros((0, 1)), np.zeros(0)).predict(["abc"])[0] == ["und"]


def test_ngrams_stay_inside_their_text():
    texts = ["abc", "", "zzz yy"]
    alone = [np.sort(next(iter(list(ngram_buckets([t]))[2:3]))[0]).tolist() for t in texts]
    idx, starts = list(ngram_buckets(texts))[2]
    ends = [*starts[1:].tolist(), len(idx)]
    assert [np.sort(idx[a:b]).tolist() for a, b in zip(starts, ends)] == alone


def test_folds(spark):
    import zlib
    rows = spark.range(200).select(F.col("id"), held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in rows)
    assert not spark.sql("select cast(null as long) id").select(held_out(F.col("id"))).first()[0]
    big = spark.range(10_000)
    assert bounded_sample(big, "id", 20_000).count() == 10_000 and 700 < bounded_sample(big, "id", 1_000).count() < 1_300


def test_nnpu_finds_the_marked_feature():
    rng = np.random.default_rng(1)
    noise = lambda: sorted(rng.choice(np.arange(1, 40), 5, replace=False).tolist())
    positive = [[0, *noise()] for _ in range(200)]
    unlabelled = [noise() if rng.random() > 0.2 else [0, *noise()] for _ in range(800)]
    w = fit_nnpu(positive, unlabelled, 40, 0.2)
    assert w[0] + w[-1] > 0 > w[-1] and w[0] == w[:-1].max()


def test_scores_equal_the_plain_sum(spark):
    """The batch scores against a sum over the texts' features, one at a time, with a fitted model."""
    docs, labels = table(spark, SF01, "documents"), table(spark, SF01, "labels")
    model = fit_toxicity(docs, labels)
    number = {f: i for i, f in enumerate(model.features)}
    want = {}
    for r in docs.collect():
        words = set(re.findall(r"[^\W\d_]+", (r.text or "").lower()))
        own = {number[f] for w in words for f in word_features(w) if f in number}
        want[r.doc_id] = 1 / (1 + math.exp(-max(-30, min(30, model.weights[-1] + sum(model.weights[i] for i in own)))))
    got = {r.doc_id: r.score for r in score_toxicity(docs, model).collect()}
    assert got == pytest.approx(want, abs=1e-9)


def test_toxicity_accuracy(spark):
    labels = table(spark, SF01, "labels").toPandas()
    got = op9_toxicity(spark, SF01).toPandas().merge(labels, on="doc_id", how="left")
    test = got[got.held_out & got.toxic.notna()]
    assert len(got) == 1000 and got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.5)).all()
    assert (test.predicted == test.toxic).mean() > 0.9


def test_toxicity_cases(spark):
    docs = spark.createDataFrame([(i, "you are scum and trash", 1) for i in range(20)] + [(50 + i, f"a fine day {i}", 2) for i in range(60)]
                                 + [(200, None, 0), (201, "", 0), (202, "scum " * 30_000, 0), (202, "scum", 0), (None, "nice", 0)],
                                 "doc_id long, text string, score int")
    labels = spark.createDataFrame([(i, 1) for i in range(20)] + [(50 + i, 0) for i in range(60)] + [(None, 1), (60, None)],
                                   "doc_id long, toxic int")
    got = {(r.doc_id): r.score for r in score_toxicity(docs, fit_toxicity(docs, labels)).collect()}
    assert got[202] > 0.5 > got[51] and got[200] == got[201] <= 0.5
    none = fit_toxicity(docs, labels.limit(0))
    assert score_toxicity(docs, none).agg(F.max("score")).first()[0] < 0.5
    assert score_toxicity(docs.limit(0), none).count() == 0
    assert FeatureIndex(["sc*"]).of("") == [] and "scum" in word_features("scum")


@pytest.mark.parametrize("seed", [1, 2])
def test_same_scores_whatever_the_batches(spark, seed):
    docs = table(spark, SF01, "documents").limit(200)
    model = fit_languages(docs, F.lit(True))
    one = {r.doc_id: r.lang_score for r in predict_languages(docs.coalesce(1), model).collect()}
    many = {r.doc_id: r.lang_score for r in predict_languages(docs.repartition(7 * seed), model).collect()}
    assert one == pytest.approx(many)
