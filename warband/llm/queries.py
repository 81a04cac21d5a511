"""Registered queries of the training-data operators and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from warband.llm import license_scan, line_dedup
from warband.llm.bpe_tree import encode_texts
from warband.llm.common import held_out
from warband.llm.decontaminate import find_leaks
from warband.llm.embedding_dedup import near_duplicate_vectors
from warband.llm.hard_negatives import mine_hard_negatives
from warband.llm.html_extract import extract_main_text
from warband.llm.language_id import fit_languages, predict_languages
from warband.llm.ngram_join import ngram_components
from warband.llm.sentencepiece_sa import encode_pieces
from warband.llm.tables import table, tokenizer_path
from warband.llm.token_counts import token_counts
from warband.llm.toxicity import fit_toxicity, score_toxicity
from warband.llm.whitening import whiten


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text under the 32k piece model, with the decoding round trip."""
    return encode_pieces(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op2_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract_main_text(table(spark, sf_dir, "pages"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(document, benchmark item) pairs: the item's text stands in the document."""
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "item_id", F.round("lcs", 6).alias("lcs"), F.col("answer").alias("answer_found"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count of every whole text under the 50k byte-level vocabulary."""
    return token_counts(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every whole text, learned from the training fold."""
    docs = table(spark, sf_dir, "documents")
    model = fit_languages(docs, ~held_out(F.col("doc_id")))
    out = predict_languages(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices found in every whole text."""
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its repeated line chunks."""
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of 4-word shingles have a Jaccard similarity of 0.85 or more."""
    return ngram_components(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every whole text, learned from the training fold's labels."""
    docs = table(spark, sf_dir, "documents")
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return score_toxicity(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of near-duplicate vectors under one label."""
    return near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the first eight whitened components of all vectors."""
    out = whiten(table(spark, sf_dir, "embeddings"))
    return out.withColumn("deviation", F.expr("try_cast(deviation as bigint)"))     # null where it needs over 64 bits


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every whole text under the 50k rank file, and the bytes they decode to, as digests."""
    import public_tokenizers
    return encode_texts(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth vector's positives, over all vectors; every seventh vector has the next label."""
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_hard_negatives(rows.select("vec_id", "embedding", label.alias("label")))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The training-corpus pipeline over ``documents``."""
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_sentencepiece": op1_sentencepiece,
        "op2_html_extract": op2_html_extract,
        "op3_decontaminate": op3_decontaminate,
        "op4_token_counts": op4_token_counts,
        "op5_language_id": op5_language_id,
        "op6_license_scan": op6_license_scan,
        "op7_line_dedup": op7_line_dedup,
        "op8_ngram_jaccard": op8_ngram_jaccard,
        "op9_toxicity": op9_toxicity,
        "op10_embedding_dedup": op10_embedding_dedup,
        "op11_embedding_whitening": op11_embedding_whitening,
        "op12_byte_bpe": op12_byte_bpe,
        "op13_hard_negatives": op13_hard_negatives,
        "pipeline": pipeline,
    }


def llm_oracles() -> dict[str, str]:
    return {
        "op6_license_scan": license_scan.oracle_sql(),
        "op7_line_dedup": line_dedup.ORACLE_SQL,
    }
