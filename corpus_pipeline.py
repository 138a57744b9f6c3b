"""A corpus pipeline over ``documents``: quality, near-copies, benchmark leaks, personal
data, packing. Each stage works on what the one before it kept, written as Parquet."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapharbor.llm import jaccard, packing, quality, surrogates, tiling
from snapharbor.llm.queries import EXAMPLE_KEY
from snapharbor.llm.shared import stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-copies (five words, similarity 0.8)."""
    return jaccard.keep_first(docs, words=5, threshold="0.8")


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents into which no benchmark item leaked."""
    return tiling.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with stand-ins for personal data."""
    docs = surrogates.replace_entities(docs, EXAMPLE_KEY)
    return docs.withColumn("n_chars", F.char_length("text").cast("bigint"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their place in the training sequences."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", good_quality),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", benchmark_leaks),
    ("PII", personal_data),
    ("best-fit packing", packed),
]

# Learned weights, tilings and token ids are not expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``; each one's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        docs = stored(stage(spark, docs, sf_dir), f"stage-{k}")
    return STAGES[-1][1](spark, docs, sf_dir)
