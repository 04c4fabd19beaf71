"""The training-text pipeline: five stages from raw documents to token digests.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next stage's documents. All but the
last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brightlake.llm import bpe, mixing, neardup, quality, queries, toxicity
from brightlake.llm.text import fold, table
from brightlake.session import scratch_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality cascade keeps."""
    return quality.keep_good(docs)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold, by a classifier fitted on labelled rows."""
    train = fold(F.col("doc_id"), 3) != 1
    model = toxicity.train_model(docs, table(spark, sf_dir, "labels"), train)
    return toxicity.drop_toxic(docs, model)


def neardup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one of smallest id."""
    return neardup.one_of_each(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the mix, each as often as it is taken."""
    return mixing.sampled_copies(docs)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of every document that is left."""
    return bpe.digests(docs, queries.vocabulary_path())


STAGES = [("quality", quality_stage), ("toxicity", toxicity_stage),
          ("near_dedup", neardup_stage), ("mixing", mixing_stage),
          ("encoding", encoding_stage)]

#: Learned scores and byte-pair merges have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
