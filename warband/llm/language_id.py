"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams per language inside the tasks and sums them with a Spark aggregation; the
result is a matrix of log-probabilities, ``buckets`` × languages, sent to the tasks once. Scoring hashes
every n-gram of every whole text and adds up the matrix rows, one numpy pass per batch.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from warband.llm.common import bounded_sample

ORDERS = (1, 2, 3, 4)
BUCKET_BITS = 16
#: Bound on the labelled rows the counts are learned from.
MAX_TRAIN_ROWS = 40_000
MAX_LANGUAGES = 2_000
UNDETERMINED = "und"
_CHARS_PER_PASS = 1_000_000
_ROWS = 1_000                # rows of a batch taken at once
_SPACE = 32


def _is_plain() -> np.ndarray:
    """For code points below 65,536: what stands for them (lower-cased letters; all else is a space)."""
    out = np.full(1 << 16, _SPACE, np.uint32)
    for i in range(1 << 16):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            out[i] = ord(low) if len(low) == 1 else i
    return out


_PLAIN: list[np.ndarray] = []


def ngram_buckets(texts: list[str]):
    """Yield (bucket indices, first index of each text, number of n-grams) per order, for all texts at once.

    Texts are laid side by side, each followed by spaces, so an n-gram starts in one text and reaches
    into no other. Runs of spaces add n-grams that are the same for every language.
    """
    if not _PLAIN:
        _PLAIN.append(_is_plain())
    pad = " " * max(ORDERS)
    points = np.frombuffer((pad + pad.join(texts) + pad).encode("utf-32-le", "surrogatepass"), np.uint32)
    sym = np.where(points < (1 << 16), _PLAIN[0][np.minimum(points, (1 << 16) - 1)], points)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + len(pad)
    starts = np.cumsum(sizes) - sizes
    end = int(sizes.sum())
    h = np.zeros(len(sym), np.uint32)
    for n in range(1, max(ORDERS) + 1):
        h = h[:len(sym) - n + 1] * np.uint32(0x01000193) + sym[n - 1:] * np.uint32(0x9E3779B1) + np.uint32(n)
        if n in ORDERS:
            mixed = h ^ (h >> np.uint32(15))
            mixed = mixed * np.uint32(0x2C1B3C6D)
            yield (mixed >> np.uint32(32 - BUCKET_BITS))[:end].astype(np.int32), starts


def _passes(texts: list[str]):
    """Index ranges of texts that hold a bounded number of characters together (or one text)."""
    lo, held = 0, 0
    for i, t in enumerate(texts):
        if held and held + len(t) > _CHARS_PER_PASS:
            yield lo, i
            lo, held = i, 0
        held += len(t)
    if texts:
        yield lo, len(texts)


def sliced(batches):
    for b in batches:
        for lo in range(0, b.num_rows, _ROWS):
            yield b.slice(lo, _ROWS)


def has_letters(text: str) -> bool:
    return any(map(str.isalpha, text))


class LanguageModel:
    def __init__(self, languages: list[str], log_prob: np.ndarray, log_prior: np.ndarray):
        self.languages, self.log_prob, self.log_prior = languages, log_prob, log_prior

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Most probable language and its posterior probability per text."""
        names, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
        if not self.languages:
            return names, scores
        use = [i for i, t in enumerate(texts) if has_letters(t)]
        for lo, hi in _passes([texts[i] for i in use]):
            part = use[lo:hi]
            total = np.tile(self.log_prior, (len(part), 1))
            for idx, starts in ngram_buckets([texts[i] for i in part]):
                for k in range(len(self.languages)):
                    total[:, k] += np.add.reduceat(self.log_prob[k][idx], starts, dtype=np.float64)
            total -= total.max(axis=1, keepdims=True)
            share = np.exp(total)
            share /= share.sum(axis=1, keepdims=True)
            best = share.argmax(axis=1)
            for i, b in zip(part, best.tolist()):
                names[i] = self.languages[b]
            scores[part] = share[np.arange(len(part)), best]
        return names, scores


def fit_languages(rows: DataFrame, train: Column, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
                  max_rows: int = MAX_TRAIN_ROWS) -> LanguageModel:
    """Learn from the text and language of rows where ``train`` holds (a bounded sample of them)."""
    labelled = rows.where(train & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    size = 1 << BUCKET_BITS

    def counted(batches):
        sums: dict[str, np.ndarray] = {}
        docs: dict[str, int] = {}
        for b in sliced(batches):
            texts, langs = b.column(0).to_pylist(), np.array(b.column(1).to_pylist(), dtype=object)
            for lang in sorted(set(langs)):
                own = [t for t, g in zip(texts, langs) if g == lang and has_letters(t)]
                docs[lang] = docs.get(lang, 0) + len(own)
                for lo, hi in _passes(own):
                    for idx, _ in ngram_buckets(own[lo:hi]):
                        sums[lang] = sums.get(lang, 0) + np.bincount(idx, minlength=size)
        for lang, s in sums.items():
            at = np.flatnonzero(s)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * (len(at) + 1)), pa.array(np.r_[at, -1].astype(np.int32)),
                 pa.array(np.r_[s[at], docs[lang]].astype(np.int64))], names=["lang", "bucket", "n"])

    counts = (bounded_sample(labelled, "id", max_rows).select("text", "lang")
              .mapInArrow(counted, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n")))
    got = counts.orderBy("lang", "bucket").toPandas()      # at most languages × (buckets + 1) rows
    languages = sorted(got["lang"].unique())
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"{len(languages)} languages; the matrix is sent to every task, at most {MAX_LANGUAGES} are taken")
    log_prob, log_prior = np.zeros((len(languages), size), np.float32), np.zeros(len(languages))
    for k, lang in enumerate(languages):
        own = got[got["lang"] == lang]
        grams = own[own["bucket"] >= 0]
        n = np.zeros(size)
        n[grams["bucket"].to_numpy()] = grams["n"].to_numpy()
        log_prob[k] = np.log((n + 0.5) / (n.sum() + 0.5 * size))
        log_prior[k] = own.loc[own["bucket"] < 0, "n"].sum()
    if len(languages):
        log_prior = np.log((log_prior + 1) / (log_prior.sum() + len(languages)))
    return LanguageModel(languages, log_prob, log_prior)


def predict_languages(rows: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """``rows`` with ``lang_pred`` and ``lang_score`` added (posterior probability, 0 to 1).

    ``und`` with score 0 where the text is null or has no letter, or where nothing was learned. Whole
    texts are scored; equal texts get equal results; ties go to the alphabetically first language. Extra
    columns pass through; ones named ``lang_pred`` or ``lang_score`` are replaced. An empty table gives
    an empty result.
    """
    keep = [c for c in rows.columns if c not in ("lang_pred", "lang_score")]
    at = keep.index(text_col)
    shared = rows.sparkSession.sparkContext.broadcast(model)
    fields = [rows.schema[c] for c in keep]

    def scored(batches):
        for b in sliced(batches):
            names, scores = shared.value.predict([t or "" for t in b.column(at).to_pylist()])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(names, pa.string()), pa.array(scores)],
                                             names=[*keep, "lang_pred", "lang_score"])

    from pyspark.sql.types import DoubleType, StringType, StructType
    schema = StructType(fields).add("lang_pred", StringType()).add("lang_score", DoubleType())
    return rows.select(*[rows[c] for c in keep]).mapInArrow(scored, schema)
