"""Documents to training sequences, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from telesift.llm import decontamination, ngram_join, packing, quality_classifier, quality_rules
from telesift.session import scratch_path

END_ID = 1


def clean_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, without their failing lines; n_chars follows the text."""
    return quality_rules.drop_rejected(docs)


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, learned from the labels of these documents, doesn't reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_classifier.drop_rejected(docs, labels)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares three quarters or more of its five-word shingles."""
    return ngram_join.keep_one(docs)


def free_of_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every token piece in sequences of 4096."""
    return packing.pack(packing.token_pieces(docs, end_id=END_ID))


STAGES = [
    ("quality_rules", clean_lines),
    ("quality_classifier", good_documents),
    ("ngram_join", one_of_near_copies),
    ("decontamination", free_of_benchmarks),
    ("packing", packed),
]

#: Learned and iterative stages can't be said in SQL; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each over what its predecessor kept, written and read again in between."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
