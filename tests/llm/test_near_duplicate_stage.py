"""The pipeline's near-duplicate stage against brute force over five-word shingles."""

import random

import corpus_pipeline as C
from tests.conftest import SF01
from tests.llm.test_dedup import brute_components


def five_words(text):
    w = text.split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def test_stage_uses_five_words_and_four_fifths(spark):
    rng = random.Random(9)
    texts = []
    for k in range(30):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.randint(80, 200))]
        texts.append(" ".join(base))
        texts.append(" ".join(base + [f"x{rng.randrange(5000)}" for _ in range(len(base) * (15 + k % 15) // 100)]))
    docs = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    want = brute_components(list(range(len(texts))), [five_words(t) for t in texts], 80)
    assert {r.doc_id for r in C.ngram_jaccard(spark, docs, SF01).collect()} == set(want)
    assert 30 < len(set(want)) < 60


def test_documents_are_told_apart_by_id_and_text(spark):
    """Repeated ids, repeated rows, null ids, empty texts and clashing columns."""
    a = " ".join(f"a{i}" for i in range(60))
    near = a + " tail"
    b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "bc")
    rows = [(1, a), (1, b), (2, near), (3, a), (3, c), (4, None), (4, None), (5, ""), (None, near), (None, c + " tail"), (6, b), (6, b), (None, "own text of a row without id"),
            (None, "own text of a row without id")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or ""), "x", 7) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, nth string, k1 int")
    left = C.ngram_jaccard(spark, docs, SF01)
    assert left.columns == docs.columns and {(r.nth, r.k1) for r in left.collect()} == {("x", 7)}
    got = sorted(((r.doc_id, r.text) for r in left.collect()), key=repr)
    assert got == sorted([(1, a), (1, b), (3, c), (4, None), (4, None), (5, ""), (None, "own text of a row without id")], key=repr)
    assert C.ngram_jaccard(spark, docs.limit(0), SF01).count() == 0
