"""Corpus preparation: toxicity, language, repeated lines, near duplicates, packing.

Each stage takes what the one before kept, as Parquet. All but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import language_id, line_dedup, ngram_join, packing, toxicity
from tessera.llm.scratch import Scratch

#: Near duplicates in the pipeline: five-word shingles, similarity 0.8 or more.
SHINGLE, NUM, DEN = 5, 80, 100
#: Rows in a batch that goes to Python. An executor's JVM holds each batch outside its heap, in buffers of up to twice its size.
BATCH_ROWS = 2_000


def small_batches(spark: SparkSession) -> None:
    """``BATCH_ROWS`` for this session, unless it has a number of its own; stages are run by whoever writes them, so it stays set."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, str(BATCH_ROWS))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return language_id.keep_identified(docs)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.drop_repeated_runs(docs, size_col="n_chars")


def keep_representatives(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return ngram_join.keep_representatives(docs, shingle=SHINGLE, num=NUM, den=DEN)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("language_id", keep_identified),
    ("line_dedup", drop_repeated_lines),
    ("ngram_join", keep_representatives),
    ("packing", pack),
]

#: The first two stages are learned models, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scratch = Scratch(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = scratch.put(stage(spark, docs, sf_dir), name)
        scratch.settle()
    return STAGES[-1][1](spark, docs, sf_dir)
