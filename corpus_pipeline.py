"""The corpus pipeline: filter, deduplicate, decontaminate and tokenise documents.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's documents. All but the last return
the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm import bpe, chosen_path, decontaminate, line_dedup, toxicity
from headway.llm.common import table
from headway.llm.queries import default_vocabulary
from headway.session import scratch_path


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that are likelier toxic than not."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, score_col="_score", segments_col="_segments").where(
        F.col("_score") < 0.5).select(*docs.columns)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without lines that an earlier line makes redundant; documents left without any line go."""
    kept = line_dedup.dedup_lines(docs).where((F.col("n_lines") == 0) | (F.col("n_kept") > 0))
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of similar documents."""
    return chosen_path.keep_first(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a passage of the benchmark."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with its columns other than the text, and the decoded text."""
    return bpe.encode_decode(docs, default_vocabulary()).drop("text")


STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_dedup_stage),
    ("ngram_jaccard_join", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("bpe", bpe_stage),
]

# the learned and the sampling stages have no SQL; the tests compare run() with a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    root = scratch_path(spark, "pipeline", uuid.uuid4().hex[:12])
    for name, stage in STAGES:
        path = f"{root}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
