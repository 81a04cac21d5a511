"""XES event logs → bronze rows.

The files are read as text records ending in the end tag of a trace, so Hadoop splits a large file
into many tasks (a trace that crosses a split is read by the split where it starts). Records that such a
tag cut inside a comment or a CDATA section are joined again. Each
record is cut to its ``<trace …>…</trace>`` fragment and parsed by ``from_xml`` with a fixed
schema: attribute elements become ``(key, value)`` arrays per element type. Memory per row
is one trace. The driver reads the first and last bytes of each file, for the namespace prefix of
its tags and its end tag; the text is scanned once, by the tasks.

Attribute rules: event ``concept:name`` (string) is the activity, the event's ``date`` is
``ts``, trace ``concept:name`` is the case id, and trace attributes overwrite event
attributes of the same key. Within one element the later duplicate wins; across element
types the order is string < float < int. Every trace attribute applies to every event of
its trace, wherever it appears in the trace. A missing ``@@index`` falls back to the
event's position within its trace. Malformed XML in a trace and files without an end tag raise.
"""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from warband.schema import BRONZE_COLUMNS
from warband.session import materialize
from warband.sources.publish import publish_path

_ATTR = T.ArrayType(T.StructType([T.StructField("_key", T.StringType()),
                                  T.StructField("_value", T.StringType())]))
_EVENT = T.StructType([T.StructField(tag, _ATTR) for tag in ("string", "float", "int", "date")])
TRACE_SCHEMA = T.StructType([T.StructField(tag, _ATTR) for tag in ("string", "float", "int")]
                            + [T.StructField("event", T.ArrayType(_EVENT))])

_NAME = "concept:name"
END = "</trace>"
EDGE = 1 << 16               # bytes read of each end of a file
_LOG_END = re.compile(rb"</(?:[\w.-]+:)?log\s*>|<(?:[\w.-]+:)?log(?:\s[^>]*)?/>")


def _entries(arr) -> Column:
    """(key, value) entries of an attribute array; NULL array → empty; NULL keys dropped."""
    a = F.coalesce(arr, F.array().cast(_ATTR))
    return F.filter(a, lambda x: x["_key"].isNotNull())


def _entry(key: str, value: Column) -> Column:
    return F.array(F.struct(F.lit(key).alias("_key"), value.cast("string").alias("_value")))


def _last_wins_map(entries: Column) -> Column:
    """Map from entries where a later entry overrides an earlier one with the same key.

    A fold that references ``entries`` once, so the entry array is built once per row.
    """
    empty = F.create_map().cast(T.MapType(T.StringType(), T.StringType()))
    return F.aggregate(entries, empty, lambda acc, x: F.map_concat(
        F.map_filter(acc, lambda k, v: k != x["_key"]), F.create_map(x["_key"], x["_value"])))


def _last_value(arr: Column, key: str | None = None) -> Column:
    a = _entries(arr)
    if key is not None:
        a = F.filter(a, lambda x: x["_key"] == key)
    return F.try_element_at(a, F.lit(-1))["_value"]


def xes_glob(path: str) -> str:
    return path if path.endswith(".xes") else f"{path.rstrip('/')}/*.xes"


def joined(batches, end: str):
    """Batches of (value, file, block) with those records joined again that ``end`` cut inside a comment or a CDATA section.

    A record whose last section is open goes on with the records that follow it in its part of the file, up to where
    the section closes. Batches without sections pass unchanged. A section that is open at the end of a part stays so."""
    held, place = "", None
    rows = lambda found: pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in found], pa.string()), pa.array([r[1] for r in found], pa.string()), pa.array([r[2] for r in found], pa.int64())],
        names=["value", "file", "block"])
    for b in batches:
        if not held and not pc.any(pc.match_substring_regex(b.column(0), r"<!--|<!\[CDATA\[")).as_py():
            yield b
            continue
        out = []
        for text, *here in zip(*(c.to_pylist() for c in b.columns)):
            if held and here != place:
                out.append((held, *place))
                held = ""
            text, place = (held + end + text if held else text), here
            held = text if open_section(text) else ""
            if not held:
                out.append((text, *here))
        yield rows(out)
    if held:
        yield rows([(held, *place)])


def whole_records(raw: DataFrame, end: str = END) -> DataFrame:
    """The text records of ``located`` as the log has them (see ``joined``); sections left open are reported by ``fragments``."""
    def run(batches):
        for b in joined(batches, end):
            yield b.select(["value"])
    return raw.mapInArrow(run, "value string")


def open_section(text: str) -> bool:
    """Whether the text ends inside a comment or a CDATA section. Markup cannot stand in attribute values, so every start is one."""
    at = 0
    while True:
        starts = [(i, close) for mark, close in (("<!--", "-->"), ("<![CDATA[", "]]>")) if (i := text.find(mark, at)) >= 0]
        if not starts:
            return False
        i, close = min(starts)
        at = text.find(close, i + 4)
        if at < 0:
            return True


def fragments(records: DataFrame, prefix: str = "") -> DataFrame:
    """Cut text records (ending before the end tag of a trace) to their ``<trace …>…</trace>`` part.

    Comments and CDATA sections are cut out first, then the prefix of the tags' names, then traces closed in their own tag
    (they hold no events). Traces do not nest, so what is left holds at most one opening tag; more, tags of another
    prefix, and sections that no part of the file closes raise.
    """
    value = F.regexp_replace("value", r"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>", "")
    if prefix:
        value = F.regexp_replace(value, rf"<(/?){re.escape(prefix)}:", "<$1")
    value = F.regexp_replace(value, r"<trace(?:\s(?:[^>\"']|\"[^\"]*\"|'[^']*')*)?/>", "")
    bad = (F.when(F.col("v").rlike(r"<[A-Za-z_][A-Za-z0-9_.-]*:trace[\s>]"), F.lit("trace tags of another namespace prefix than their log's"))
           .when(F.col("v").rlike(r"<!--|<!\[CDATA\["), F.lit("a comment or CDATA section reaches beyond its part of the file: read with a larger "
                                                              "spark.sql.files.maxPartitionBytes, or it is not closed at all"))
           .when(F.col("v").rlike(r"(?s)<trace[\s>].*<trace[\s>]"), F.lit("a trace that is not closed by a plain end tag")))
    found = F.regexp_extract("v", r"(?s)<trace[\s>].*", 0)
    frag = F.when(bad.isNotNull(), F.raise_error(bad)).when(found != "", F.concat(found, F.lit(END)))
    return records.select(value.alias("v")).select(frag.alias("xml")).where(F.col("xml").isNotNull())


@dataclass(frozen=True)
class LogFile:
    path: str
    prefix: str          # of the log's tags, "" if none
    ended: bool


def log_files(spark: SparkSession, path: str) -> list[LogFile]:
    """The ``*.xes`` files directly in ``path`` with what their first and last ``EDGE`` bytes tell. The driver reads these bytes only."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(xes_glob(path))
    fs = at.getFileSystem(conf)

    def edges(status) -> LogFile:
        stream, size = fs.open(status.getPath()), status.getLen()
        try:
            n = min(size, EDGE)
            head = bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream, n))
            stream.seek(size - n)
            tail = bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream, n))
        finally:
            stream.close()
        head = re.sub(rb"(?s)<!--.*?-->", b"", head)
        prefix = re.search(rb"<(?:([\w.-]+):)?log[\s>/]", head)
        return LogFile(status.getPath().toString(), (prefix[1] or b"").decode() if prefix else "", bool(_LOG_END.search(tail)))

    with ThreadPoolExecutor(16) as pool:
        return list(pool.map(edges, fs.globStatus(at) or []))


def trace_fragments(spark: SparkSession, path: str) -> DataFrame:
    """One row per ``<trace>`` element of every ``*.xes`` file directly in ``path``."""
    out = None
    for raw, end, prefix in _log_texts(spark, path, "trace"):
        part = fragments(whole_records(raw, end), prefix)
        out = part if out is None else out.unionByName(part)
    return out


def located(raw: DataFrame) -> DataFrame:
    return raw.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def read_xes(spark: SparkSession, path: str, large_traces: bool = False) -> DataFrame:
    """I1 + I2: one bronze row per event, trace attributes merged in.

    ``large_traces`` reads logs of which single traces do not fit a task: records are events then, and the traces'
    attributes are joined to them (see ``events_of_pieces``)."""
    if large_traces:
        return events_of_pieces(trace_pieces(spark, path))
    return events_of_fragments(trace_fragments(spark, path))


def _log_texts(spark: SparkSession, path: str, tag: str):
    """(records that end in the end tag of ``tag``, that end tag, prefix) of the files of each namespace prefix."""
    files = log_files(spark, path)
    if not files:
        raise FileNotFoundError(f"No .xes files found in {path}")
    if cut := [f.path for f in files if not f.ended][:3]:
        raise ValueError("log files without an end tag (cut off?): " + ", ".join(cut))
    for prefix in sorted({f.prefix for f in files}):
        end = f"</{prefix}:{tag}>" if prefix else f"</{tag}>"
        raw = spark.read.option("lineSep", end).text([f.path for f in files if f.prefix == prefix])
        yield located(raw), end, prefix


def events_of_fragments(frags: DataFrame) -> DataFrame:
    """Parse ``xml`` trace fragments into bronze rows (stateless: batch or stream).

    The trace-attribute map is built once per trace; each event folds only its own entries.
    """
    traces = frags.select(F.from_xml("xml", TRACE_SCHEMA, {"mode": "FAILFAST"}).alias("t"))
    t = F.col("t")
    trace_entries = F.concat(_entries(t["string"]), _entries(t["float"]), _entries(t["int"]))
    return bronze_rows(traces.select(_last_wins_map(trace_entries).alias("_tm"), _last_value(t["string"], _NAME).alias("_case"),
                                     F.coalesce(t["event"], F.array().cast(T.ArrayType(_EVENT))).alias("_evs"))
                       .select("_tm", "_case", F.posexplode("_evs").alias("_pos", "e")))


def bronze_rows(events: DataFrame) -> DataFrame:
    """Bronze rows of events ``(_tm, _case, _pos, e)``: the trace's attribute map and name, the place in the trace, the event.

    A column takes the trace's value when the trace has that key, else the event's.
    """
    e = F.col("e")
    own = F.concat(F.filter(_entries(e["string"]), lambda x: x["_key"] != _NAME),
                   _entries(e["float"]), _entries(e["int"]))
    idx = F.coalesce(_last_value(F.filter(own, lambda x: x["_key"] == "@@index")), F.col("_pos").cast("string"))
    event_entries = F.concat(
        _entry("case_id", F.col("_case")), own,
        _entry("activity", _last_value(e["string"], _NAME)),
        _entry("ts", _last_value(e["date"])),
        _entry("event_id", F.concat(F.coalesce(F.col("_case"), F.lit("None")), F.lit("-"), idx)))
    merged = events.select("_tm", _last_wins_map(event_entries).alias("_em"))
    tm, em = F.col("_tm"), F.col("_em")

    def value(key: str):
        return F.when(F.map_contains_key(tm, F.lit(key)), tm[key]).otherwise(em[key])

    cols = [F.try_to_timestamp(value("ts")).alias("ts") if c == "ts" else value(c).alias(c) for c in BRONZE_COLUMNS]
    hidden = [*BRONZE_COLUMNS, _NAME]
    extra = F.map_concat(
        F.map_filter(em, lambda k, v: ~k.isin(*hidden) & ~F.array_contains(F.map_keys(tm), k)),
        F.map_filter(tm, lambda k, v: ~k.isin(*hidden)))
    return merged.select(*cols, extra.alias("attrs"))


PIECE = "kind string, file string, block bigint, trace bigint, nth bigint, xml string"


def trace_pieces(spark: SparkSession, path: str) -> DataFrame:
    """The logs cut at event ends: rows of ``kind`` event (one event), attributes (a stretch of a trace between events) and
    part (the end of a part of a file), in ``PIECE`` columns.

    ``trace`` numbers the traces that begin in the part of the file that starts at byte ``block``; -1 is what goes on from
    before. A part's row holds its last trace, or -1 if none began or ended there, and ``open`` or ``closed`` as its xml. ``nth``
    counts the events of a trace in the part, before the piece. The text is scanned once: the pieces are stored."""
    out = None
    for raw, end, prefix in _log_texts(spark, path, "event"):
        part = raw.mapInArrow(_cutter(end, prefix), PIECE)
        out = part if out is None else out.unionByName(part)
    return materialize(out, "xes-pieces")


def _cutter(end: str, prefix: str):
    tags = re.compile(r"(<trace(?:\s(?:[^>\"']|\"[^\"]*\"|'[^']*')*)?/?>|</trace\s*>|<event(?:\s(?:[^>\"']|\"[^\"]*\"|'[^']*')*)?/>)")
    sections = re.compile(r"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>")
    first = re.compile(r"<event[\s>]")
    strip = re.compile(rf"<(/?){re.escape(prefix)}:") if prefix else None

    def run(batches):
        place, trace, inside, seen, nth = None, -1, False, False, 0
        out: list[tuple] = []

        def closed():
            return ("part", *place, trace if seen else -1, 0, "open" if inside else "closed")

        def batch():
            found = pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in out], t) for k, t in enumerate((pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()))],
                names=["kind", "file", "block", "trace", "nth", "xml"])
            out.clear()
            return found

        for b in joined(batches, end):
            for text, *here in zip(*(c.to_pylist() for c in b.columns)):
                if here != place:
                    if place is not None:
                        out.append(closed())
                    place, trace, seen, nth = here, -1, False, 0
                    inside = here[1] > 0                 # what goes on from before, if anything does
                text = sections.sub("", text)
                if "<!--" in text or "<![CDATA[" in text:
                    raise ValueError(f"{place[0]}: a comment or CDATA section reaches beyond its part of the file: read with a larger "
                                     "spark.sql.files.maxPartitionBytes, or it is not closed at all")
                if strip:
                    text = strip.sub(r"<\1", text)
                cuts = tags.split(text)
                for k, piece in enumerate(cuts):
                    if k % 2:
                        if piece.startswith("<trace"):
                            trace, inside, seen, nth = trace + 1, not piece.endswith("/>"), True, 0
                        elif piece.startswith("</trace"):
                            inside, seen = False, True
                        elif inside:
                            out.append(("event", *place, trace, nth, piece))
                            nth += 1
                        continue
                    if not inside:
                        continue
                    begin = first.search(piece) if k == len(cuts) - 1 else None
                    at = begin.start() if begin else -1
                    if (head := piece[:at] if begin else piece).strip() and (begin or k < len(cuts) - 1):
                        out.append(("attributes", *place, trace, nth, f"<trace>{head}</trace>"))
                    if begin:
                        out.append(("event", *place, trace, nth, piece[at:] + "</event>"))
                        nth += 1
                if len(out) >= 5_000:
                    yield batch()
        if place is not None:
            out.append(closed())
        yield batch()
    return run


def events_of_pieces(pieces: DataFrame) -> DataFrame:
    """Bronze rows of stored pieces: each trace's attributes are gathered over the parts it reaches into and joined to its
    events. A trace of any size is as many rows as it has events; a hot trace's events can be split over tasks."""
    parts = pieces.where("kind = 'part'")
    back = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)        # a row per part of a file
    last = F.last(F.when((F.col("trace") >= 0) | (F.col("xml") == "closed"), F.struct("block", "trace", "xml")), ignorenulls=True).over(back)
    parts = parts.select("file", "block", last.alias("from")).select(
        "file", "block", F.when(F.col("from.xml") == "open", F.col("from.block")).alias("_b"), F.when(F.col("from.xml") == "open", F.col("from.trace")).alias("_t"))
    parts = materialize(parts, "xes-parts")
    new = F.col("trace") >= 0
    rows = (pieces.where("kind <> 'part'").join(parts, ["file", "block"])
            .select("kind", "file", "block", "nth", "xml", F.when(new, F.col("block")).otherwise(F.col("_b")).alias("_b"),
                    F.when(new, F.col("trace")).otherwise(F.col("_t")).alias("_t")).where("_b is not null"))
    key = ["file", "_b", "_t"]
    rows = materialize(rows, "xes-placed")
    t = F.from_xml("xml", T.StructType(TRACE_SCHEMA.fields[:3]), {"mode": "FAILFAST"})
    heads = rows.where("kind = 'attributes'").select(*key, "block", "nth", t.alias("t"))
    lists = heads.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("block", "nth", "t"))).alias("ts"))     # a trace's own attributes
    of = lambda tag: F.flatten(F.transform("ts", lambda x: _entries(x["t"][tag])))
    heads = lists.select(*key, _last_wins_map(F.concat(of("string"), of("float"), of("int"))).alias("_tm"), _last_value(of("string"), _NAME).alias("_case"))
    heads = materialize(heads, "xes-traces")
    events = rows.where("kind = 'event'")
    # an event's place in its trace: that in its part, after the events of the trace in the parts before
    before = F.sum("n").over(Window.partitionBy(*key).orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    about = (events.groupBy(*key, "block").agg(F.count("*").alias("n")).select(*key, "block", F.coalesce(before, F.lit(0)).alias("before"))
             .join(heads, key, "left"))
    about = materialize(about, "xes-trace-parts")
    none = F.create_map().cast(T.MapType(T.StringType(), T.StringType()))
    return bronze_rows(events.join(about, [*key, "block"]).select(
        F.coalesce("_tm", none).alias("_tm"), "_case", (F.col("before") + F.col("nth")).alias("_pos"),
        F.from_xml("xml", _EVENT, {"mode": "FAILFAST"}).alias("e")))


def write_bronze(bronze: DataFrame, path: str) -> None:
    """Replace the bronze parquet folder."""
    publish_path(bronze, path)
