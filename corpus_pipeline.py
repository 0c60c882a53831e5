"""Corpus pipeline: toxicity, near duplicates, benchmark decontamination, source mix and shards, in this order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from jsonloom.llm import decontamination, mixing, near_dedup, sharding
from jsonloom.llm import toxicity as toxic
from jsonloom.session import cut_lineage


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under the threshold stay."""
    return toxic.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays: the one with the smallest id."""
    return near_dedup.drop_near_duplicates(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item stay."""
    return decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to their target weights; a document is there as often as it is taken, up to three times."""
    return mixing.mix_documents(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard of nearly equal bytes and their slot in it."""
    return sharding.shard_documents(docs)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("benchmark", benchmark),
    ("mix", mix),
    ("shards", shards),
]

#: training, sketches and alignments have no SQL form; the stages are tested against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written to the shared folder and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
