"""Toxicity scores by non-negative positive-unlabelled learning (Kiryo et al., NeurIPS 2017).

A linear classifier is trained from confirmed toxic texts (positives) and unlabelled texts, whose
toxic share is the class prior π. The risk is ``π·E_P[l(f)] + max(0, E_U[l(−f)] − π·E_P[l(−f)])`` with the
logistic loss: what the positives inside the unlabelled texts add to its negative part is taken out, and
the rest is kept from going below zero. Features are words and word beginnings that occur in several
positives and more often there than in unlabelled texts; a text has a feature or has it not, so
scores do not thin out in long texts.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from warband.llm.common import bounded_sample, held_out
from warband.session import materialize

#: Bounds on the labelled and unlabelled rows the classifier is fitted on, and on its size.
MAX_POSITIVE, MAX_UNLABELLED, MAX_FEATURES = 6_000, 12_000, 4_096
MIN_POSITIVE_TEXTS = 5
DECAYS = (0.0, 3e-5, 1e-4, 3e-4, 1e-3)
PREFIX_LENGTHS = (3, 4, 5, 6, 7, 8)
MAX_WORDS = 500_000
_WORD = re.compile(r"[^\W\d_]+")


def word_features(word: str) -> list[str]:
    """The word itself and its beginnings, a trailing ``*`` marking the latter."""
    return [word] + [word[:k] + "*" for k in PREFIX_LENGTHS if k <= len(word)]


class FeatureIndex:
    """Feature numbers of texts; remembers words already looked up."""

    def __init__(self, features: list[str]):
        self.number = {f: i for i, f in enumerate(features)}
        self.words: dict[str, tuple[int, ...]] = {}

    def of(self, text: str) -> list[int]:
        if len(self.words) > MAX_WORDS:
            self.words.clear()
        out: set[int] = set()
        for w in set(_WORD.findall(text.lower())):
            got = self.words.get(w)
            if got is None:
                got = self.words[w] = tuple(self.number[f] for f in word_features(w) if f in self.number)
            if got:
                out.update(got)
        return sorted(out)


def flat(rows: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """(feature, row) of every feature of the rows."""
    return (np.fromiter((i for r in rows for i in r), np.int64, sum(map(len, rows))),
            np.repeat(np.arange(len(rows)), list(map(len, rows))))


def margins(rows: list[list[int]], w: np.ndarray) -> np.ndarray:
    f, r = flat(rows)
    return np.bincount(r, w[f], len(rows))[:len(rows)] + w[-1]


def ranked(positive: list[list[int]], unlabelled: list[list[int]], w: np.ndarray) -> float:
    """Share of (positive, unlabelled) pairs in the right order, ties counted half, to three digits."""
    p, u = margins(positive, w), np.sort(margins(unlabelled, w))
    return round(float((np.searchsorted(u, p) + np.searchsorted(u, p, side="right")).mean() / 2 / len(u)), 3)


def fit_with_decay(positive: list[list[int]], unlabelled: list[list[int]], n_features: int, prior: float) -> np.ndarray:
    """``fit_nnpu`` with the weight decay that ranks a fifth of the rows best, which the others were fitted without
    (of equally good ones the smallest)."""
    if min(len(positive), len(unlabelled)) < 5:
        return fit_nnpu(positive, unlabelled, n_features, prior, decay=DECAYS[0])
    kept = [[r for i, r in enumerate(rows) if i % 5] for rows in (positive, unlabelled)]
    order = {d: ranked(positive[::5], unlabelled[::5], fit_nnpu(*kept, n_features, prior, decay=d)) for d in DECAYS}
    return fit_nnpu(positive, unlabelled, n_features, prior, decay=min(DECAYS, key=lambda d: (-order[d], d)))


def fit_nnpu(positive: list[list[int]], unlabelled: list[list[int]], n_features: int, prior: float,
             steps: int = 400, rate: float = 0.05, decay: float = 0.0) -> np.ndarray:
    """Weights (the last is the bias) minimising the non-negative risk, by Adam over all rows."""
    (fp, rp), (fu, ru) = flat(positive), flat(unlabelled)
    np_, nu = max(1, len(positive)), max(1, len(unlabelled))
    w = np.zeros(n_features + 1)
    w[-1] = np.log(prior / (1 - prior))
    m, v = np.zeros_like(w), np.zeros_like(w)
    sig = lambda x: 1 / (1 + np.exp(-np.clip(x, -30, 30)))
    score = lambda f, r, n: np.bincount(r, w[f], n) + w[-1]

    def pull(f, r, g):                    # gradient of a sum of row losses with row slopes g
        return np.r_[np.bincount(f, g[r], n_features), g.sum()]

    for t in range(1, steps + 1):
        sp, su = score(fp, rp, np_)[:len(positive)], score(fu, ru, nu)[:len(unlabelled)]
        neg = (np.logaddexp(0, su).mean() if len(su) else 0) - prior * (np.logaddexp(0, sp).mean() if len(sp) else 0)
        grad_neg = pull(fu, ru, sig(su) / nu) - pull(fp, rp, prior * sig(sp) / np_)
        if neg >= 0:
            grad = pull(fp, rp, -prior * sig(-sp) / np_) + grad_neg
        else:                             # step back from a negative part below zero
            grad = -grad_neg
        grad[:-1] += decay * w[:-1]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        w -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w


class ToxicityModel:
    def __init__(self, features: list[str], weights: np.ndarray):
        self.features, self.weights = features, weights

    def index(self) -> FeatureIndex:
        return FeatureIndex(self.features)

    def scores(self, index: FeatureIndex, texts: list[str | None]) -> np.ndarray:
        s = margins([index.of(t or "") for t in texts], self.weights)
        return 1 / (1 + np.exp(-np.clip(s, -30, 30)))


def fit_toxicity(docs: DataFrame, labels: DataFrame, train: Column | None = None, id_col: str = "doc_id",
                 text_col: str = "text", label_col: str = "toxic") -> ToxicityModel:
    """Learn from rows outside the test fold (or where ``train`` holds on the id). Positives are texts
    labelled 1; unlabelled texts are taken from all documents of the training rows, whatever their
    label; the class prior is the toxic share among the labelled training rows."""
    train = ~held_out(F.col("id")) if train is None else train
    lab = (labels.select(labels[id_col].alias("id"), labels[label_col].alias("y")).where(F.col("id").isNotNull() & F.col("y").isNotNull())
           .where(train).groupBy("id").agg(F.max("y").alias("y")))
    n, n_pos = lab.agg(F.count("*"), F.coalesce(F.sum((F.col("y") == 1).cast("int")), F.lit(0))).first()
    if not n_pos:
        return ToxicityModel([], np.array([-30.0]))
    prior = min(0.9, max(1e-4, n_pos / n))
    texts = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).where(train & F.col("text").isNotNull())
    pos_ids = F.broadcast(bounded_sample(lab.where("y = 1").select("id"), "id", MAX_POSITIVE))   # at most about MAX_POSITIVE ids
    sample = (texts.join(pos_ids, "id").select("text", F.lit(1).alias("positive"))
              .unionByName(bounded_sample(texts, "id", MAX_UNLABELLED).select("text", F.lit(0).alias("positive"))))
    sample = materialize(sample, "toxicity-sample")       # bounded, and read three times

    def per_word(batches):
        p, u = Counter(), Counter()
        for b in batches:
            for t, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                (p if y else u).update({f for w in set(_WORD.findall(t.lower())) for f in word_features(w)})
        names = list(p.keys() | u.keys())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([p[f] for f in names], pa.int64()),
                                          pa.array([u[f] for f in names], pa.int64())], names=["f", "p", "u"])

    size = sample.groupBy("positive").count().collect()
    size = {r["positive"]: r["count"] for r in size}
    np_, nu = size.get(1, 0), size.get(0, 0)
    lift = (F.col("p") + 0.5) / (np_ + 1.0) / ((F.col("u") + 0.5) / (nu + 1.0))
    chosen = (sample.mapInArrow(per_word, "f string, p bigint, u bigint").groupBy("f").agg(F.sum("p").alias("p"), F.sum("u").alias("u"))
              .where(F.col("p") >= MIN_POSITIVE_TEXTS).where(lift > 1.5)
              .withColumn("gain", F.col("p") * F.log(lift)).orderBy(F.desc("gain"), "f").limit(MAX_FEATURES))
    features = [r["f"] for r in chosen.collect()]         # at most MAX_FEATURES
    if not features:
        return ToxicityModel([], np.array([-30.0]))

    def numbered(batches):
        index = FeatureIndex(features)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array([index.of(t) for t in b.column(0).to_pylist()], pa.list_(pa.int32()))],
                                             names=["positive", "features"])

    rows = sample.mapInArrow(numbered, "positive int, features array<int>").collect()   # the bounded sample, as feature numbers
    w = fit_with_decay([list(r["features"]) for r in rows if r["positive"]],
                       [list(r["features"]) for r in rows if not r["positive"]], len(features), prior)
    return ToxicityModel(features, w)


def score_toxicity(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id and ``score`` (0 to 1). Null and empty texts get the score of a text without
    features. Equal texts get equal scores; other columns are not read; an empty table gives an empty
    result."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches):
        model = shared.value
        index = model.index()
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.scores(index, b.column(1).to_pylist()), pa.float64())],
                                             names=["id", "score"])

    return (docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
            .mapInArrow(scored, f"`id` {docs.schema[id_col].dataType.simpleString()}, score double").withColumnRenamed("id", id_col))
