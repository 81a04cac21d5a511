"""Line dedup and decontamination leave only the table that their result reads."""

from warband import session
from warband.llm.decontaminate import decontaminate
from warband.llm.line_dedup import dedup_lines


def _left(start):
    return {p.rsplit("/", 1)[1].rsplit("-", 1)[0] for p in session._WRITTEN[start:]}


def test_tables_go_when_the_result_stands(spark):
    passage = " ".join(f"word{k}" for k in range(60))
    docs = spark.createDataFrame([(1, passage + "\nown line one"), (2, passage + "\nown line two"), (3, None)], "doc_id long, text string")
    start = len(session._WRITTEN)
    out = dedup_lines(docs)
    assert _left(start) == {"removed-lines"}
    assert {r.doc_id: r.lines_removed for r in out.collect()} == {1: 0, 2: 1, 3: 0}
    start = len(session._WRITTEN)
    out = decontaminate(docs, spark.createDataFrame([(7, passage)], "item_id long, text string"))
    assert _left(start) == {"leaks"}
    assert [r.doc_id for r in out.collect()] == [3]
