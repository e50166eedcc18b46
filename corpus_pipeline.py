"""A training corpus from `documents`: toxic texts out, near copies out, repeated passages out,
sources mixed to their weights, and all packed into sequences."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakeward.llm import mixing, packing, simhash, substrings
from lakeward.llm.common import table
from lakeward.llm.toxicity import without_toxic
from lakeward.session import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are predicted toxic go."""
    return without_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays: the one with the smallest doc_id."""
    return simhash.near_dedup(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 or more words that an earlier document holds are cut out."""
    return substrings.remove_repeats(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document stands in the corpus as often as its source's target weight asks for."""
    return mixing.mixed_documents(docs)


def packing_plan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 2048 tokens."""
    return packing.packed(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("source_mix", source_mix),
    ("packing", packing_plan),
]

# The stages hash, learn and tokenize; SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stage reads what the one before it wrote."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
