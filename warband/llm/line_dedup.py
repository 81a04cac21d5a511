"""Removal of line chunks that repeat across the corpus, with content-defined chunk borders.

Lines are the stretches between line feeds. A chunk is a run of consecutive lines that each occur more
than once in the corpus; inside a run a border falls around every line of ``long_line`` words or more,
wherever the rolling hash over the last two line hashes has a fixed remainder, and wherever a line occurs in
the corpus another number of times than the line before, so that a frequent line beside a passage is no part of
its chunks. A chunk of fewer than ``min_words`` words counts only as one with a neighbour that follows or
precedes it directly. All these rules look at line contents and corpus counts only, so a passage put at another
place of another document is cut in the same way from its first border on. Chunks whose hash occurs more than
once are compared byte for byte (by grouping on their text); of equal chunks the first (smallest id, then place)
stays and the others go.

Everything is DataFrame code. What is shuffled are line hashes, the texts of repeated chunks, and the texts
once at the end; hot lines are counted with partial aggregation and joined against stored counts, so
that Spark can split a hot line's rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from warband.llm.common import row_key
from warband.session import drop_tables, materialize, scratch_scope

MIN_WORDS = 10       # chunks with fewer words count only together with the next one: short lines repeat by chance
LONG_LINE = 12       # words from which a line is a chunk of its own
BORDER_DIGITS = ("0", "4", "8", "c")      # a border at one of four rolling hashes on average


def words_in(line: Column) -> Column:
    """Words separated by single spaces: one more than the spaces of the trimmed line, 0 if blank."""
    t = F.trim(line)
    return F.when(t == "", 0).otherwise(F.length(t) - F.length(F.translate(t, " ", "")) + 1)


def removed_lines(docs: DataFrame, id_col: str, text_col: str, min_words: int, long_line: int) -> DataFrame:
    """(k1, k2, gone): per document the positions of the lines to remove."""
    key = ["k1", "k2"]
    base = docs.select(*row_key(id_col, text_col), F.col(id_col).alias("id"), F.split(text_col, "\n").alias("ls"))
    # the outer form: an inner one makes Spark test the array's size first, splitting the texts twice
    lines = materialize(base.select(*key, "id", F.posexplode_outer("ls").alias("pos", "line")).where("pos is not null")
                        .select(*key, "id", "pos", F.md5("line").alias("h"), words_in(F.col("line")).alias("nw")), "line-hashes")
    often = materialize(lines.groupBy("h").agg(F.count("*").alias("n")).where("n > 1"), "repeated-lines")
    w = Window.partitionBy(*key).orderBy("pos")
    before = lambda c: F.lag(c).over(w)
    rolled = F.substring(F.md5(F.concat(before("h"), F.col("h"))), 1, 1)
    opens = (F.coalesce(before("pos") + 1 != F.col("pos"), F.lit(True)) | (before("n") != F.col("n")) | (F.col("nw") >= long_line)
             | (before("nw") >= long_line) | rolled.isin(*BORDER_DIGITS))
    # stored before repeated rows go: aggregated in the join's stage, a hot line's rows could not be split over tasks
    runs = materialize(lines.join(often, "h"), "run-lines").distinct().withColumn("opens", F.when(opens, 1).otherwise(0))
    runs = runs.withColumn("chunk", F.sum("opens").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    parts = (runs.groupBy(*key, "chunk").agg(F.first("id").alias("id"), F.min("pos").alias("a"), F.max("pos").alias("b"),
                                             F.sum("nw").alias("nw"), F.sort_array(F.collect_list(F.struct("pos", "h"))).alias("hs")))
    w = Window.partitionBy(*key).orderBy("a")
    after = lambda c: F.lead(c).over(w)
    parts = parts.select("*", *[F.when(after("a") == F.col("b") + 1, after(c)).alias(f"next_{c}") for c in ("b", "nw", "hs")])
    one = F.when(F.col("nw") >= min_words, F.array(F.struct("a", "b", "hs")))
    two = F.when((F.least("nw", "next_nw") < min_words) & (F.col("nw") + F.col("next_nw") >= min_words),
                 F.array(F.struct(F.col("a"), F.col("next_b").alias("b"), F.concat("hs", "next_hs").alias("hs"))))
    none = F.array().cast("array<struct<a:int,b:int,hs:array<struct<pos:int,h:string>>>>")
    chunks = (parts.select(*key, "id", F.explode(F.concat(F.coalesce(one, none), F.coalesce(two, none))).alias("u"))
              .select(*key, "id", "u.a", "u.b", F.xxhash64(F.transform("u.hs", lambda x: x["h"])).alias("hash")))
    chunks = materialize(chunks, "line-chunks")
    again = materialize(chunks.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash"), "repeated-chunks")
    spans = chunks.join(again, "hash").groupBy(*key).agg(F.first("id").alias("id"), F.collect_list(F.struct("a", "b", "hash")).alias("spans"))
    texts = base.select(*key, "ls").join(spans, key).select(*key, "id", "ls", F.explode("spans").alias("s"))
    body = F.array_join(F.slice("ls", F.col("s.a") + 1, F.col("s.b") - F.col("s.a") + 1), "\n")
    texts = materialize(texts.select(*key, "id", F.col("s.a").alias("a"), F.col("s.b").alias("b"), F.col("s.hash").alias("hash"),
                                     body.alias("body")).distinct(), "chunk-texts")
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", "k1", "k2", "a")
    first = materialize(texts.groupBy("hash", "body").agg(F.min(place).alias("first")), "first-chunks")
    gone = (texts.join(first, ["hash", "body"]).where(place != F.col("first"))
            .groupBy(*key).agg(F.array_distinct(F.flatten(F.collect_list(F.sequence("a", "b")))).alias("gone")))
    return materialize(gone, "removed-lines")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
                long_line: int = LONG_LINE) -> DataFrame:
    """``docs`` with repeated chunks removed from ``text_col``; adds ``lines_removed``.

    One row per input row, other columns unchanged (a column named ``lines_removed`` is replaced). Null texts stay null, empty
    texts stay empty, with 0 lines removed. A text whose lines all go becomes empty. Rows that repeat
    id and text count as one document and get the same result. A null id orders last. An empty table
    gives an empty result.
    """
    with scratch_scope() as tables:
        gone = removed_lines(docs, id_col, text_col, min_words, long_line)
    drop_tables(docs.sparkSession, [t for t in tables if not t.rsplit("/", 1)[1].startswith("removed-lines-")])
    k1, k2 = row_key(id_col, text_col)
    keep = [c for c in docs.columns if c != "lines_removed"]
    rows = docs.select(F.struct(*keep).alias("row"), k1, k2).join(gone, ["k1", "k2"], "left")
    # the lines are a column of their own: inside the lambda they would be split anew for each line
    rows = rows.withColumn("ls", F.when(F.col("gone").isNotNull(), F.split(F.col("row")[text_col], "\n")))
    left = F.array_except(F.sequence(F.lit(0), F.size("ls") - 1), F.col("gone"))
    text = F.when(F.col("gone").isNull(), F.col("row")[text_col]).otherwise(F.array_join(F.transform(left, lambda i: F.get("ls", i)), "\n"))
    return rows.select(*[text.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in keep],
                       F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("bigint").alias("lines_removed"))


ORACLE_SQL = f"""
WITH d AS (SELECT DISTINCT doc_id, text FROM documents WHERE text IS NOT NULL),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
             generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM d),
c AS (SELECT line, COUNT(*) AS n FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY line HAVING COUNT(*) > 1),
r AS (SELECT l.*, n, md5(line) AS h, CASE WHEN trim(line) = '' THEN 0
        ELSE length(trim(line)) - length(replace(trim(line), ' ', '')) + 1 END AS nw
      FROM l JOIN c USING (line)),
o AS (SELECT *, CASE WHEN lag(pos) OVER w IS DISTINCT FROM pos - 1 OR lag(n) OVER w <> n OR nw >= {LONG_LINE} OR lag(nw) OVER w >= {LONG_LINE}
                       OR substr(md5(lag(h) OVER w || h), 1, 1) IN ('0', '4', '8', 'c') THEN 1 ELSE 0 END AS opens
      FROM r WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
n AS (SELECT *, SUM(opens) OVER (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS chunk FROM o),
p AS (SELECT doc_id, MIN(pos) AS a, MAX(pos) AS b, SUM(nw) AS nw, string_agg(line, chr(10) ORDER BY pos) AS body
      FROM n GROUP BY doc_id, chunk),
q AS (SELECT *, lead(a) OVER v AS na, lead(b) OVER v AS nb, lead(nw) OVER v AS nnw, lead(body) OVER v AS nbody
      FROM p WINDOW v AS (PARTITION BY doc_id ORDER BY a)),
k AS (SELECT doc_id, a, b, body FROM q WHERE nw >= {MIN_WORDS} UNION ALL
      SELECT doc_id, a, nb, body || chr(10) || nbody FROM q
      WHERE na = b + 1 AND least(nw, nnw) < {MIN_WORDS} AND nw + nnw >= {MIN_WORDS}),
f AS (SELECT *, row_number() OVER (PARTITION BY body ORDER BY doc_id, a) AS nth FROM k),
g AS (SELECT DISTINCT doc_id, unnest(generate_series(a, b)) AS pos FROM f WHERE nth > 1),
t AS (SELECT l.doc_id, string_agg(line, chr(10) ORDER BY l.pos) FILTER (WHERE g.pos IS NULL) AS text, COUNT(g.pos) AS lines_removed
      FROM l LEFT JOIN g ON l.doc_id = g.doc_id AND l.pos = g.pos GROUP BY l.doc_id)
SELECT documents.doc_id, CASE WHEN documents.text IS NULL THEN NULL ELSE COALESCE(t.text, '') END AS text,
       CAST(COALESCE(t.lines_removed, 0) AS BIGINT) AS lines_removed
FROM documents LEFT JOIN t USING (doc_id)"""
