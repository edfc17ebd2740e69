"""From raw documents to a training mix, in stages; each works on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tasteframe.llm import decontaminate, mixing, near_dedup, quality
from tasteframe.scratch import fresh_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble scores at 0.3 or more; it learns from ``labels`` and the given documents."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), 0.3)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five words, similarity 0.8 or more."""
    return near_dedup.keep_one(docs, 0.8, 5)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of ``benchmark``."""
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with ``copies`` (how often) and ``target_words`` (of the source)."""
    return mixing.mixed_documents(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("near-dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
]

#: The first stages learn a model and search by random sketches, which SQL cannot say.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet to the shared folder and reread as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = fresh_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
