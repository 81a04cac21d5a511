"""Batches of whole texts and of shingle sets stay small in bytes, and the results do not depend on them."""

import random

import pyarrow as pa

from warband.llm.ngram_join import ngram_components
from warband.session import BATCH_BYTES, ship_package


def test_batches_of_texts_are_bounded(spark):
    def described(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], names=["n", "size"])

    ship_package(spark)
    texts = spark.range(0, 4_000, 1, 1).selectExpr("repeat('word ', 1000) as text")
    sent = texts.mapInArrow(described, "n bigint, size bigint").collect()
    assert sum(r.n for r in sent) == 4_000 and max(r.size for r in sent) < 5_000_000


def test_a_value_of_the_caller_stays(spark):
    own, fresh = spark.newSession(), spark.newSession()
    own.conf.set(BATCH_BYTES[0], "9m")
    for session, bound in ((own, "9m"), (fresh, BATCH_BYTES[1])):
        ship_package(session)
        assert session.conf.get(BATCH_BYTES[0]) == bound


def test_components_do_not_depend_on_batches(spark):
    rng = random.Random(4)
    base = [[f"w{rng.randrange(9000)}" for _ in range(150)] for _ in range(25)]
    texts = [" ".join(b[:k] + [f"x{rng.randrange(9000)}"] + b[k:]) for b in base for k in range(0, 150, 50)] + [None, "", "one word"]
    tiny = spark.newSession()
    tiny.conf.set(BATCH_BYTES[0], "2k")
    docs = tiny.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = {r.doc_id: r.component_id for r in ngram_components(docs).collect()}
    assert got == {k: k // 3 * 3 if k < 75 else k for k in range(78)}
