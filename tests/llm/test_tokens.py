"""Token counts and piece encoding against the tokenizer libraries."""

import random

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.conftest import SF001
from warband.llm.sentencepiece_sa import Encoder, encode_pieces, occurrence_ranges, suffix_array
from warband.llm.tables import table, tokenizer_path
from warband.llm.token_counts import PrefixCounter, token_counts

BPE, PIECES = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
PARTS = ["a", "b", "'re", "'s", "'ll", " ", "  ", "   ", "\n", "\t", "the", "<|endoftext|>", "<s>", "<0x0A>", "é", "日本", "1", "23",
         "!", "...", "🙂", "\xa0", "<|end", "aaaa", "====", "▁", "\x00", "벨", "The", "ing", "²", "½"]


def mixed(n, seed=1, parts=PARTS):
    rng = random.Random(seed)
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(n)]


@pytest.fixture(scope="module")
def counter():
    return PrefixCounter(BPE)


@pytest.fixture(scope="module")
def encoder():
    return Encoder(PIECES)


def test_counts_equal_the_library(counter):
    lib = Tokenizer.from_file(BPE)
    for t in mixed(1500) + ["a" * 3000, " " * 700, "-" * 500]:
        assert counter.count(t) == len(lib.encode(t, add_special_tokens=False).ids), t


def test_every_prefix_equals_the_library(counter):
    lib = Tokenizer.from_file(BPE)
    for t in mixed(250, seed=2):
        want = [len(lib.encode(t[:i], add_special_tokens=False).ids) for i in range(len(t) + 1)]
        assert counter.every_prefix(t) == want, t


def test_fitting_prefix(counter):
    text = "The quick brown foxes unbelievably jumped over it. " * 5
    words, counts = counter.spans(text)
    for budget in (0, 1, 5, 17, sum(counts), 10_000):
        n = counter.fitting(words, counts, budget)
        assert counter.count(text[:n]) <= budget
        assert n == len(text) or counter.every_prefix(text)[n + 1] > budget


def test_token_counts_rows(spark):
    lib = Tokenizer.from_file(BPE)
    docs = table(spark, SF001, "documents")
    got = {r.doc_id: r for r in token_counts(docs, BPE).collect()}
    for r in docs.collect():
        n = len(lib.encode(r.text, add_special_tokens=False).ids)
        assert (got[r.doc_id].n_tokens, got[r.doc_id].over_limit, got[r.doc_id].n_bytes) == (n, n > 1024, len(r.text.encode()))


def test_token_counts_cases(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, "hi there", "x"), (3, "hi there", "x"), (None, "é\n", None), (5, "word " * 30_000, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = sorted(((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts(docs, BPE).collect()), key=str)
    assert sorted(got, key=str) == sorted([(1, 0, 0, False), (2, 0, 0, False), (3, 8, 2, False), (3, 8, 2, False), (None, 3, 2, False),
                                           (5, 150_000, 30_001, True)], key=str)
    table_ = token_counts(docs.where("doc_id = 3").limit(1), BPE, prefixes=True).first().prefix_tokens
    assert len(table_) == 9 and table_[-1] == 2
    assert token_counts(docs.limit(0), BPE).count() == 0


def test_pieces_equal_the_library(encoder):
    lib = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = mixed(3000, seed=3) + [" " * k for k in range(40)] + ["a" + " " * k + "b" for k in range(40)] + ["", "x" * 2000]
    ids, ends = encoder.encode(texts)
    want = lib.encode(texts, num_threads=1)
    assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])] == want
    assert encoder.decode(ids, ends) == [t.replace("▁", " ") for t in texts]


def test_forgetting_changes_nothing(encoder):
    texts = mixed(200, seed=4)
    first = encoder.encode(texts)[0].tolist()
    encoder.forget()
    assert encoder.encode(texts)[0].tolist() == first


def test_suffix_array_and_ranges():
    rng = np.random.default_rng(5)
    codes = rng.integers(0, 4, 300)
    order = suffix_array(codes, 16)
    keys = [tuple(codes[i:i + 16]) for i in order]
    assert keys == sorted(keys)
    pieces = np.zeros((40, 5), np.int64)
    lengths = rng.integers(1, 6, 40)
    for k, n in enumerate(lengths):
        pieces[k, :n] = rng.integers(1, 4, n)
    lo, hi = occurrence_ranges(codes, order, pieces, lengths)
    for k, n in enumerate(lengths):
        want = [i for i in range(len(codes)) if i + n <= len(codes) and (codes[i:i + n] == pieces[k, :n]).all()]
        assert sorted(order[lo[k]:hi[k]].tolist()) == want


def test_encode_pieces_cases(spark):
    rows = [(1, None), (2, ""), (3, "hi there"), (3, "hi there"), (None, "é\n"), (5, "ab" * 20_000)]
    got = encode_pieces(spark.createDataFrame(rows, "doc_id long, text string").withColumn("token_ids", F.lit(1)), PIECES)
    assert got.where("not round_trip").count() == 0
    by = {r.doc_id: r for r in got.collect()}
    assert by[1].token_ids == [] and by[2].n_tokens == 0 and len(by[5].token_ids) == by[5].n_tokens
    assert got.count() == 6 and encode_pieces(spark.createDataFrame([], "doc_id long, text string"), PIECES).count() == 0
