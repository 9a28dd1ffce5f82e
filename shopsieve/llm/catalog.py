"""The registered queries of the operators, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shopsieve.llm import (
    conversations,
    decontaminate,
    interactions,
    lines,
    packing,
    pieces,
    quality,
    secret_scan,
    shingles,
    token_counts,
    token_files,
    toxicity,
    wrappers,
)
from shopsieve.llm.common import documents, table
from shopsieve.llm.pretokens import vocabulary_file
from shopsieve.sinks.scratch import new_folder


def op1_pigeonhole_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, with the item and its distance."""
    return decontaminate.contaminations(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op2_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(documents(spark, sf_dir), new_folder(spark, "secret-ledger"))
    return secret_scan.digest(found)


def op3_wrapper_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.main_text(table(spark, sf_dir, "pages"))


def op4_ranked_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "token-files")
    token_files.write(documents(spark, sf_dir), folder, vocabulary_file("byte_bpe_50k.json"), end_id=0)
    return token_files.read(spark, folder, with_ids=False)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their later similar lines removed, and how many of their lines went."""
    return lines.dedup_lines(documents(spark, sf_dir), counts=True).select("doc_id", "text", "n_lines", "n_removed")


def op6_partenum_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingles.jaccard_components(documents(spark, sf_dir))


def op7_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), vocabulary_file("word_bpe_49k.json"))


def op8_isolation_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op9_lexicon_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op10_pretoken_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir), vocabulary_file("byte_bpe_50k.json"))


def op11_survivor_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(conversations.damaged(table(spark, sf_dir, "conversations")))


def op12_chunk_table_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = pieces.encode_pieces(documents(spark, sf_dir), vocabulary_file("piece_bpe_32k.model"), decoded=True)
    return pieces.digests(encoded)


def op13_filter_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interactions.audit(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_pigeonhole_decontamination,
        op2_secret_ledger,
        op3_wrapper_text,
        op4_ranked_token_files,
        op5_line_dedup,
        op6_partenum_components,
        op7_harmonic_packing,
        op8_isolation_quality,
        op9_lexicon_toxicity,
        op10_pretoken_counts,
        op11_survivor_repair,
        op12_chunk_table_pieces,
        op13_filter_interactions,
    )
}
