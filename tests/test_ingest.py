import os
import re

import pytest
from pyspark.sql import functions as F

from tests.xes_samples import HEADER, attr, edge_log, event, iso, trace, write_log
from warband.sources.xes import read_xes


def _split_edge_log(folder):
    text = edge_log()
    body = text[len(HEADER):-len("</log>\n")]
    traces = ["\t<trace>" + t for t in body.split("\t<trace>") if t.strip()]
    write_log(folder, "a.xes", HEADER + "".join(traces[:4]) + "</log>\n")
    write_log(folder, "b.xes", HEADER + "".join(traces[4:]) + "</log>\n")
    write_log(folder, "notes.txt", "<trace>not a log</trace>")


def test_edge_log_rows(spark, scratch):
    _split_edge_log(scratch)
    df = read_xes(spark, scratch)
    rows = {r["event_id"]: r.asDict() for r in df.collect()}
    assert len(rows) == 131 + 4 + 3 + 2 + 1 + 2 + 2 + 1
    assert rows["c1-1060"]["ts"] is not None and rows["c1-1060"]["amount"] == "1.5"
    # missing @@index → position in the trace
    assert "c2-1" in rows and rows["c2-1"]["win"] == "True"
    # timestamp without fraction still parses
    assert rows["c2-1"]["ts"] is not None
    # trace attribute placed after the events applies to all of them
    assert {r["elo"] for r in rows.values() if r["case_id"] == "c3"} == {"1300.0"}
    # escaped entity is decoded
    assert rows["c3-3"]["activity"] == "Research & Age Test"
    # case id and trace attributes overwrite; concept:name is not kept as an extra column
    assert rows["c4-1"]["strategy"] is None and rows["c4-1"]["attrs"] == {}
    assert rows["c5-1"]["match_id"] is None


def test_many_splits_equal_one(spark, scratch):
    b = __import__("datetime").datetime(2023, 1, 1)
    traces = []
    for t in range(300):
        evs = [event("Queue Villager", iso(b, i), index=t * 1000 + i, win=str(t % 2)) for i in range(40)]
        traces.append(trace(f"case{t}", [attr("string", "match_id", f"m{t}"), attr("string", "player_id", f"p{t % 7}")], evs))
    write_log(scratch, "big.xes", HEADER + "".join(traces) + "</log>\n")
    size = os.path.getsize(os.path.join(scratch, "big.xes"))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size // 9))
    try:
        df = read_xes(spark, scratch)
        assert df.rdd.getNumPartitions() >= 9
        stats = df.agg(F.count("*").alias("n"), F.countDistinct("case_id").alias("c"),
                       F.countDistinct("event_id").alias("e")).first()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert (stats.n, stats.c, stats.e) == (12000, 300, 12000)


def test_no_xes_file(spark, scratch):
    write_log(scratch, "readme.txt", "nothing")
    with pytest.raises(FileNotFoundError):
        read_xes(spark, scratch).count()


def _prefixed(text):
    return re.sub(r"<(/?)(log|trace|event|string|date|float|int)\b", r"<\1xes:\2", text).replace("xmlns=", "xmlns:xes=")


def test_prefixed_tags_read_like_plain_ones(spark, scratch):
    """Logs whose tags carry a namespace prefix, beside plain ones; a prefix of its own on a trace raises."""
    plain, prefixed, mixed = (os.path.join(scratch, d) for d in ("plain", "prefixed", "mixed"))
    write_log(plain, "a.xes", edge_log())
    write_log(prefixed, "a.xes", _prefixed(edge_log()))
    want = sorted(map(repr, read_xes(spark, plain).collect()))
    assert sorted(map(repr, read_xes(spark, prefixed).collect())) == want and len(want) == 146
    write_log(prefixed, "b.xes", HEADER + REAL["a"] + "</log>")
    assert read_xes(spark, prefixed).count() == 148
    write_log(mixed, "a.xes", HEADER + _prefixed(REAL["a"]) + "</log>")
    with pytest.raises(Exception, match="prefix"):
        read_xes(spark, mixed).count()


REAL = {c: trace(c, [attr("string", "match_id", "m" + c)], [event("Queue Villager", "2023-01-01T00:00:00+00:00", index=i) for i in (1, 2)])
        for c in ("a", "b")}


@pytest.mark.parametrize("odd", ["<trace/>", '<trace kind="x > y"/>\n', "<!-- <trace> of old -->", "<!-- <trace/> -->", "<traces n=\"1\"/>",
                                 "<![CDATA[<trace>]]>", "<trace></trace>"])
def test_odd_elements_lose_no_trace(spark, scratch, odd):
    write_log(scratch, "o.xes", HEADER + odd + REAL["a"] + odd + REAL["b"] + "</log>\n")
    rows = read_xes(spark, scratch).collect()
    assert sorted(r["event_id"] for r in rows) == ["a-1", "a-2", "b-1", "b-2"]


@pytest.mark.parametrize("body", [REAL["a"].replace("Queue", "Queue & Build"), REAL["a"].replace("</event>", "</evnt>", 1),
                                  REAL["a"].replace("\t</trace>", "<!-- </trace>"), REAL["a"].replace("</trace>", "</trace >") + REAL["a"]])
def test_malformed_traces_raise(spark, scratch, body):
    write_log(scratch, "m.xes", HEADER + REAL["b"] + body + "</log>\n")
    with pytest.raises(Exception):
        read_xes(spark, scratch).collect()


OLD = REAL["b"].replace("case", "old")


@pytest.mark.parametrize("section", ["<!-- x </trace> -->", f"<!-- {OLD} {OLD} -->", f"<![CDATA[{OLD}]]>", "<!-- </trace> --><!-- <![CDATA[ </trace> -->",
                                     "<![CDATA[ <!-- </trace> ]]>", "<!-- > -- </trace>\n</trace> -->"])
def test_end_tags_inside_sections(spark, scratch, section):
    """Comments and CDATA sections that hold end tags of traces, before, inside, between and after traces."""
    inside = REAL["b"].replace("</event>", "</event>" + section, 1)
    write_log(scratch, "s.xes", HEADER + section + REAL["a"] + section + inside + section + "</log>\n")
    rows = read_xes(spark, scratch).collect()
    assert sorted(r["event_id"] for r in rows) == ["a-1", "a-2", "b-1", "b-2"]


def test_a_section_beyond_its_part_of_the_file_raises(spark, scratch):
    write_log(scratch, "s.xes", HEADER + REAL["a"] + "<!-- " + "x </trace> " * 400 + "-->" + REAL["b"] + "</log>\n")
    assert read_xes(spark, scratch).count() == 4
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        with pytest.raises(Exception, match="maxPartitionBytes"):
            read_xes(spark, scratch).count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_the_text_is_scanned_once(spark, scratch):
    write_log(scratch, "s.xes", edge_log())
    plan = read_xes(spark, scratch)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 1 and "Exchange" not in plan


@pytest.mark.parametrize("part_bytes", [300, 1_000, 7_000, 1 << 20])
def test_events_joined_with_their_traces(spark, scratch, part_bytes):
    """Records of single events: traces over many parts of a file, attributes before, between and after events, prefixes,
    sections, missing indexes and empty traces give the rows of the reader by traces."""
    plain, prefixed = edge_log(), _prefixed(edge_log())
    odd = "<!-- <trace> -->" + REAL["a"].replace("</event>", '</event><string key="map_type" value="late"/>', 1) + "<trace/><trace></trace>" \
        + REAL["b"].replace('<int key="@@index" value="1"/>', "").replace('<int key="@@index" value="2"/>', "") + '<trace kind="x > y"><event/></trace>'
    write_log(scratch, "a.xes", plain)
    write_log(scratch, "b.xes", prefixed)
    write_log(scratch, "c.xes", HEADER + odd + "</log>\n")
    want = sorted(map(repr, read_xes(spark, scratch).collect()))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(part_bytes))
    try:
        got = sorted(map(repr, read_xes(spark, scratch, large_traces=True).collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == want and len(want) > 290


def test_a_trace_is_never_one_row(spark, scratch):
    """One trace of many events over many parts: no stored piece is longer than an event, and places count through."""
    from warband.sources.xes import events_of_pieces, trace_pieces
    evs = [event("Queue Villager", "2023-01-01T00:00:00+00:00").replace("\t", "") for _ in range(3_000)]
    write_log(scratch, "long.xes", HEADER + trace("one", [attr("string", "match_id", "m1")], evs) + "</log>\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    try:
        pieces = trace_pieces(spark, scratch)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert pieces.agg(F.max(F.length("xml"))).first()[0] < 600 and pieces.where("kind = 'part'").count() > 5
    rows = events_of_pieces(pieces).collect()
    assert {r["event_id"] for r in rows} == {f"one-{i}" for i in range(3_000)} and {r["match_id"] for r in rows} == {"m1"}


def test_cut_off_file_raises(spark, scratch):
    whole = HEADER + REAL["a"] + REAL["b"] + "</log>\n"
    write_log(scratch, "whole.xes", whole)
    write_log(scratch, "empty.xes", HEADER + "</log>")
    write_log(scratch, "void.xes", '<?xml version="1.0"?><log xes.version="2016"/>')
    assert read_xes(spark, scratch).count() == 4
    write_log(scratch, "cut.xes", whole[:whole.rindex("</event>") + len("</event>")])
    with pytest.raises(ValueError, match="cut.xes"):
        read_xes(spark, scratch)


def test_bronze_survives_the_way_through_xes(spark):
    """I1–I3 on a given table: written as XES text, read back, equal row by row."""
    from tests.conftest import SF001
    from warband.sources.adapter import load_bronze, traces_from_bronze
    from warband.sources.xes import events_of_fragments
    want = load_bronze(spark, SF001)
    got = events_of_fragments(traces_from_bronze(want)).drop("attrs").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
