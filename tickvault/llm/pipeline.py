"""Stages of the corpus pipeline.

Every stage but the last returns the columns of ``documents``; each is written as
Parquet below the shared checkpoint folder and read again before the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickvault.llm import decontaminate, jaccard_join, line_dedup
from tickvault.llm.common import learnable, stage
from tickvault.llm.language_id import UNDETERMINED, predict, train
from tickvault.llm.mixing import Mix

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is determined (posterior at least 0.5)."""
    model = train(docs.where(learnable()))
    return predict(docs, model, keep=tuple(COLUMNS)) \
        .where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= 0.5)).select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that a later document repeats; n_chars of what is left."""
    return line_dedup.dedup_lines(docs.select(*COLUMNS), line_dedup.find(docs)) \
        .withColumn("n_chars", F.char_length("text").cast("long"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of near copies."""
    return jaccard_join.keep_one(docs.select(*COLUMNS))


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of the benchmark."""
    return decontaminate.remove_documents(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Blocks of training text in their output shards: shard, source, slot, block, doc_ids, n_words, text."""
    return Mix(docs, with_text=True).texts()


STAGES = [("language_id", language), ("line_dedup", lines), ("jaccard_join", near_duplicates),
          ("decontamination", benchmark), ("source_mixing", mix)]
ORACLE_SQL = None       # learned language and drawn mixture: not SQL; tested against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
