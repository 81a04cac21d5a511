"""Training-corpus pipeline over ``documents``: language ID, line dedup, near-duplicate removal, benchmark
decontamination, tokens.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; its rows are stored and read again as the next
stage's ``docs``. All stages but the last return the columns of ``documents``. Null or empty texts, repeated rows,
extra columns and empty tables are handled as the operators in ``warband.llm`` state. Rows with a null ``doc_id`` are
kept by all stages that their text passes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from warband.llm.common import held_out, row_key
from warband.llm.decontaminate import decontaminate
from warband.llm.language_id import UNDETERMINED, fit_languages, predict_languages
from warband.llm.line_dedup import dedup_lines
from warband.llm.ngram_join import ngram_components
from warband.llm.sentencepiece_sa import encode_pieces
from warband.llm.tables import table, tokenizer_path
from warband.session import materialize, ship_package

MIN_LANGUAGE_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a recognised language: texts without letters, and those whose best language has a
    posterior below ``MIN_LANGUAGE_SCORE``, go."""
    ship_package(spark)
    model = fit_languages(docs, ~held_out(F.col("doc_id")))
    named = predict_languages(docs, model)
    return named.where((F.col("lang_pred") != UNDETERMINED) & (F.col("lang_score") >= MIN_LANGUAGE_SCORE)).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without chunks of lines that an earlier document holds; ``n_chars`` follows the text. A document
    of which nothing is left goes."""
    left = dedup_lines(docs)
    return left.where((F.col("lines_removed") == 0) | (F.col("text") != "")).withColumn(
        "n_chars", F.when(F.col("lines_removed") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))).select(*docs.columns)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (five-word shingles, Jaccard similarity of 0.8 or more): the one with the
    smallest id, null ids last. Documents are told apart by id and text, so another text under the same id stays unless it
    is a near-duplicate itself. Documents without words stay."""
    ship_package(spark)
    key = ["k1", "k2"]
    groups = materialize(ngram_components(docs, size=5, num=80, with_keys=True).select("doc_id", "group_key", *key), "near-duplicates")
    first = groups.where("group_key is not null").groupBy("group_key").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", *key)).alias("first")).select(*[F.col("first")[k].alias(k) for k in key])
    wordless = groups.where("group_key is null").select(*key).distinct()
    kept = materialize(first.withColumn("one", F.lit(True)).union(wordless.withColumn("one", F.lit(False))), "kept-documents")
    rows = docs.select(F.struct(*docs.columns).alias("row"), *row_key(docs["doc_id"], docs["text"])).join(kept, key)
    nth = F.row_number().over(Window.partitionBy(*key).orderBy(F.lit(1)))      # a kept row that is repeated stays once
    return rows.withColumn("nth", nth).where("nth = 1 or not one").select(*[F.col("row")[c].alias(c) for c in docs.columns])


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item was found."""
    ship_package(spark)
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of the remaining texts, with their decoding round trip."""
    ship_package(spark)
    return encode_pieces(docs, tokenizer_path("piece_bpe_32k.model"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("ngram_jaccard", ngram_jaccard),
    ("benchmark_decontamination", benchmark_decontamination),
    ("sentencepiece", sentencepiece),
]

#: Language ID and the piece encoder cannot be written in SQL; ``tests/llm`` compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are stored before the next one reads them."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
