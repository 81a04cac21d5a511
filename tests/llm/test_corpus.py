"""Decontamination and the pipeline against brute force."""

import re

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline as C
from tests.conftest import SF01
from warband.llm import line_dedup
from warband.llm.decontaminate import answer_of, decontaminate, find_leaks, holds, lcs_length, words_of
from warband.llm.tables import table, tokenizer_path
from tests.llm.test_dedup import brute_components, duck_rows, word_set


def plain(text):
    return " " + " ".join(re.findall(r"[^\W_]+", text.lower())) + " "


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        old = 0
        for j, y in enumerate(b, 1):
            old, row[j] = row[j], old + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_lcs_and_answers():
    rng = np.random.default_rng(1)
    for _ in range(300):
        a, b = rng.integers(0, 5, rng.integers(0, 20)).tolist(), rng.integers(0, 5, rng.integers(0, 90)).tolist()
        assert lcs_length(a, b) == lcs(a, b)
    assert answer_of("Who? He did.\nIt was the cat. ") == [b"it", b"was", b"the", b"cat"] and answer_of("...") == []
    assert holds([1, 2, 3], [2, 3]) and not holds([1, 2, 3], [3, 2]) and not holds([1], [])


def test_every_planted_item_is_found(spark):
    docs, bench = table(spark, SF01, "documents"), table(spark, SF01, "benchmark")
    got = {(r.doc_id, r.item_id) for r in find_leaks(docs, bench).collect()}
    items = {r.item_id: plain(r.text) for r in bench.collect()}
    item_words = {r.item_id: words_of(r.text) for r in bench.collect()}
    want = {(r.doc_id, i) for r in docs.collect() for t in [plain(r.text)] for i, q in items.items() if q in t}
    assert want <= got and len(want) >= 10
    texts = {r.doc_id: words_of(r.text) for r in docs.collect()}
    assert all(lcs(item_words[i], texts[d]) >= 0.6 * len(item_words[i]) for d, i in got)


def test_paraphrases_and_cases(spark):
    item = ("which of the rivers named below carries most water into the northern ocean every year according to surveyors. "
            "answer: the great yenisei river of siberia")
    near = item.replace("named below", "listed here").replace("every year", "annually").replace("according to", "as told by")
    noise = [f"sentence {k} speaks about thing{k} and matter{k * 7} without end or meaning" for k in range(80)]
    rows = [(k, noise[k]) for k in range(80)] + [(100, noise[0] + " " + item.upper() + " " + noise[1]), (101, noise[2] + " " + near), (102, None), (103, ""),
                                                 (104, "!!!"), (100, noise[0] + " " + item.upper() + " " + noise[1]), (None, item),
                                                 (105, ". ".join(noise) * 30 + " " + item), (106, item[:60])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("k1", F.lit("clash"))
    bench = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "?!")], "item_id long, text string")
    found = find_leaks(docs.select("doc_id", "text"), bench)
    assert {(r.doc_id, r.item_id) for r in found.collect()} == {(100, 1), (101, 1), (None, 1), (105, 1)}
    left = decontaminate(docs, bench)
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == set(range(80)) | {102, 103, 104, 106}
    assert decontaminate(docs, bench.limit(0)).count() == len(rows) and decontaminate(docs.limit(0), bench).count() == 0


def test_pipeline_equals_brute_force(spark):
    """Every stage on its own input, each against a plain version of its decision."""
    docs = table(spark, SF01, "documents").where("doc_id < 350 or doc_id % 10 = 0")
    odd = spark.createDataFrame([(9001, None, None, "s", None), (9002, "", "en", "s", 0), (9003, "1234 ---", "en", "s", 8),
                                 (9004, docs.first().text, "en", "s", 5), (None, "a text of its own without an id here", "en", None, None)], docs.schema)
    rows = docs.union(odd).cache()
    out = {}
    for name, stage in C.STAGES:
        got = stage(spark, rows, SF01).cache()
        out[name] = (rows, got)
        if name != C.STAGES[-1][0]:
            assert got.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        rows = got
    before, after = out["language_id"]
    assert {r.doc_id for r in before.collect()} - {r.doc_id for r in after.collect()} == {9001, 9002, 9003}

    before, after = out["line_dedup"]
    sql = "SELECT doc_id, text, lines_removed FROM (" + line_dedup.ORACLE_SQL + ")"
    want = {r[0]: r[1] for r in duck_rows(sql, documents=before.where("doc_id is not null").select("doc_id", "text").toPandas()) if r[1] or not r[2]}
    got = {r.doc_id: r for r in after.collect()}
    assert {k: v.text for k, v in got.items() if k is not None} == want and got[None].text.startswith("a text")
    assert all(r.n_chars == len(r.text) for k, r in got.items() if k is not None and k < 9000)

    before, after = out["ngram_jaccard"]
    known = sorted((r.doc_id, r.text) for r in before.where("doc_id is not null").collect())
    comp = brute_components([d for d, _ in known], [word_set(t) for _, t in known])
    assert {r.doc_id for r in after.where("doc_id is not null").collect()} == {d for (d, _), c in zip(known, comp) if c == d}

    before, after = out["benchmark_decontamination"]
    items = [plain(r.text) for r in table(spark, SF01, "benchmark").collect()]
    dirty = {r.doc_id for r in before.collect() if any(q in plain(r.text) for q in items)}
    gone = {r.doc_id for r in before.collect()} - {r.doc_id for r in after.collect()}
    assert dirty <= gone and len(gone) - len(dirty) <= 1

    before, after = out["sentencepiece"]
    lib = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    texts = {r.doc_id: r.text for r in before.collect()}
    got = after.collect()
    assert len(got) == len(texts) and all(r.token_ids == lib.encode(texts[r.doc_id]) and r.round_trip for r in got)


def test_repeated_and_empty_rows(spark):
    one = "enough words of plain english text that nobody else would ever write down here"
    rows = [(1, one, "en", "s", 1), (1, one, "en", "s", 1), (2, one, "en", "s", 1)]
    docs = spark.createDataFrame(rows, table(spark, SF01, "documents").schema)
    assert [r.doc_id for r in C.ngram_jaccard(spark, docs, SF01).collect()] == [1]
    for name, stage in C.STAGES:
        assert stage(spark, docs.limit(0), SF01).count() == 0, name


def test_stages():
    assert [n for n, _ in C.STAGES] == ["language_id", "line_dedup", "ngram_jaccard", "benchmark_decontamination", "sentencepiece"]
    assert C.ORACLE_SQL is None


@pytest.mark.parametrize("name", ["op1_sentencepiece", "op2_html_extract", "op3_decontaminate", "op4_token_counts", "op5_language_id",
                                  "op6_license_scan", "op7_line_dedup", "op8_ngram_jaccard", "op9_toxicity", "op10_embedding_dedup", "pipeline"])
def test_registered(name):
    import __spark_entry__ as E
    assert name in E.queries()
