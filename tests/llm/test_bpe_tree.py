"""Tree-reduction encoding against the rank-file library."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from tests.conftest import SF001
from warband.llm.bpe_tree import LEAF, QUEUE_FROM, TreeEncoder, encode_texts
from warband.llm.queries import op12_byte_bpe
from warband.llm.tables import table, tokenizer_path

FILES = ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"]
EMPTY = hashlib.sha256(b"").hexdigest()


def library(name):
    with open(tokenizer_path(name), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module", params=FILES)
def both(request):
    return TreeEncoder(tokenizer_path(request.param), public_tokenizers.PATTERN), library(request.param)


def ids_of(encoder, text):
    return np.frombuffer(encoder.encode(text), "<u4").astype(np.int64)


def odd_texts(n, seed):
    rng = random.Random(seed)
    parts = ["a", "aa", " ", "  ", "\n", "\t", "\x1c", "\x85", "​", "'s", "'LL", "ing", "tion", "é", "日本", "🙂", "123", "½", "==",
             "<|endoftext|>", "\x00", "Ǆ", "٣", "----", "The"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(n)]


def test_ids_equal_the_library(both):
    encoder, lib = both
    rng = random.Random(5)
    letters = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(3000))
    for t in odd_texts(800, 1) + ["a" * 5000, "ab" * 2001, "=" * 999, " " * 3000, "日本語" * 700, letters, letters[:LEAF], letters[:LEAF + 1]]:
        ids = ids_of(encoder, t)
        assert ids.tolist() == lib.encode_ordinary(t), t[:80]
        assert encoder.decode(ids) == t.encode()


def test_joined_stretches_equal_plain_merging(both):
    """The join of any two encodings is the encoding of the whole, whichever place the cut has."""
    encoder, _ = both
    rng = random.Random(2)
    for _ in range(300):
        data = bytes(rng.choice(b"aabcein -=\xe6\x97\xa5") for _ in range(rng.randint(2, 60)))
        cut = rng.randint(0, len(data))
        assert encoder.join(encoder.merged(data[:cut]), encoder.merged(data[cut:])) == encoder.merged(data)


def test_queue_merging_equals_plain_merging(both):
    encoder, _ = both
    rng = random.Random(3)
    for _ in range(100):
        data = bytes(rng.choice(b"aabbein") for _ in range(QUEUE_FROM - 1))
        assert encoder._merged_by_queue(data) == encoder.merged(data)


def test_long_word_is_not_quadratic(both):
    import time
    encoder, _ = both
    for word in ("a" * 400_000, "".join(random.Random(4).choice("abcdefgh") for _ in range(400_000))):
        start = time.time()
        assert encoder.decode(ids_of(encoder, word)) == word.encode()
        assert time.time() - start < 30


def test_rows(spark):
    lib = library(FILES[0])
    docs = table(spark, SF001, "documents")
    want = {}
    for r in docs.collect():
        ids = lib.encode_ordinary(r.text or "")
        want[r.doc_id] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                          hashlib.sha256((r.text or "").encode()).hexdigest())
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in op12_byte_bpe(spark, SF001).collect()}
    assert got == want


def test_cases(spark):
    docs = spark.createDataFrame([(1, None, 5), (1, "", 6), (None, "hello world", 7), (None, "hello world", 7), (2, "x" * 100_000, 8)],
                                 "doc_id long, text string, n_tokens int")
    path, pattern = tokenizer_path(FILES[0]), public_tokenizers.PATTERN
    rows = encode_texts(docs, path, pattern, with_ids=True).collect()
    assert sorted((r.doc_id or 0, r.n_tokens, len(r.ids)) for r in rows)[:4] == [(0, 2, 2), (0, 2, 2), (1, 0, 0), (1, 0, 0)]
    assert {r.decoded_sha256 for r in rows if r.doc_id == 1} == {r.ids_sha256 for r in rows if r.doc_id == 1} == {EMPTY}
    assert encode_texts(docs.limit(0), path, pattern).count() == 0
