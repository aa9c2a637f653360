"""A training-data pipeline: five operators, each on the documents that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparkloom.llm import bpe, decontaminate, line_dedup, minhash, quality
from sparkloom.llm.scratch import save


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model of trusted text does not reject."""
    return quality.keep_good(spark, docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that stand, or nearly stand, in a document or place before."""
    return line_dedup.without_repeated_lines(spark, docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return minhash.one_of_each(spark, docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item."""
    return decontaminate.without_test_items(spark, docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and hashes of the encoded and decoded texts."""
    return bpe.round_trip(docs, bpe.vocabulary_path())


STAGES = [
    ("quality", quality_stage),
    ("line_dedup", line_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("tokens", token_stage),
]

#: Models, shingle links and merges have no SQL; tests/llm holds the line stage and the operators of the others against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage returns is written, and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = save(docs)
    return docs
