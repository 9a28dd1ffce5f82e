"""A training corpus from the documents table, stage by stage.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and returns the
columns of ``docs``; the last returns packed pieces. ``run`` writes each stage's result as Parquet in
the shared folder and reads it back for the next one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shopsieve.llm import decontaminate, lines, packing, quality, shingles
from shopsieve.llm.common import documents, table
from shopsieve.llm.pretokens import vocabulary_file
from shopsieve.sinks.scratch import hand_off


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines similar to an earlier one go, and documents that have no word left by it."""
    return lines.dedup_lines(docs, drop_emptied=True)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of similar ones stays."""
    return shingles.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of what is left in sequences of 2,048 tokens."""
    return packing.pack(docs, vocabulary_file("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("pack", pack),
]

#: Isolation forests and tokenizers are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = hand_off(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
