"""The driver's queries for this subpackage's operators, and their oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import language_id, line_dedup, lm_scoring, media, ngram_join, nn_descent, packing, token_counts, toxicity, transducer


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op4_lossless_webp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.round_trip(_table(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select("doc_id", "text", "lines_total", "lines_removed", "runs_removed")


def op1_nnls_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, sf_dir, "documents"))


def op3_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_texts(_table(spark, sf_dir, "documents"))


def op6_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(_table(spark, sf_dir, "documents"))


def op8_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transducer.round_trip(_table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(_table(spark, sf_dir, "documents"))


def op10_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nn_descent.near_duplicates(_table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_nnls_packing": op1_nnls_packing,
    "op2_token_counts": op2_token_counts,
    "op3_deleted_interpolation": op3_deleted_interpolation,
    "op4_lossless_webp": op4_lossless_webp,
    "op5_line_dedup": op5_line_dedup,
    "op6_toxicity_chain": op6_toxicity_chain,
    "op7_ngram_jaccard_join": op7_ngram_jaccard_join,
    "op8_bpe_transducer": op8_bpe_transducer,
    "op9_language_id": op9_language_id,
    "op10_nn_descent": op10_nn_descent,
}

ORACLES = {
    "op5_line_dedup": line_dedup.ORACLE_SQL,
}
