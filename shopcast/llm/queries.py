"""Queries of the subpackage: key -> callable(spark, sf_dir) -> DataFrame, and
SQL for the keys that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shopcast.llm import (byte_bpe, collocations, fertility, fingerprints, html_extract, hyperminhash, mixing, paragraph_dedup,
                         pii, quality_trees, ranked_search, suffix_dedup, token_counts)
from shopcast.llm.oracle import SQL

__all__ = ["QUERIES", "SQL"]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of every whole text without repeats of 100 bytes."""
    return suffix_dedup.find_repeats(documents(spark, sf_dir))


def op2_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document, by whole texts."""
    return hyperminhash.near_duplicates(documents(spark, sf_dir))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every whole text."""
    return pii.find(documents(spark, sf_dir))


def op4_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate paragraphs of every whole text."""
    return paragraph_dedup.find_paragraphs(documents(spark, sf_dir))


def op5_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the fertility verdict of every whole text."""
    return fertility.judge(documents(spark, sf_dir))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text under the multilingual rank file, decoded again."""
    return byte_bpe.encode_digest(documents(spark, sf_dir))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every whole text and its edited text."""
    return fingerprints.edited_pairs(documents(spark, sf_dir))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mix of one and a half times the corpus takes of each document."""
    return mixing.plan_rows(documents(spark, sf_dir))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count of every whole text under the word vocabulary."""
    return token_counts.count_tokens(documents(spark, sf_dir))


def op10_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page, labelled by a network fitted on a bounded sample."""
    return html_extract.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of every item, searched in all documents."""
    return ranked_search.search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 phrases of every language, counted over all documents."""
    return collocations.find_collocations(documents(spark, sf_dir))


def op13_quality_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every whole text, learned from rows that are not held out."""
    return quality_trees.classify(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_suffix_dedup, op2_hyperminhash, op3_pii, op4_paragraph_dedup, op5_fertility, op6_byte_bpe,
                            op7_fingerprints, op8_mixing, op9_token_counts, op10_html_extract, op11_ranked_search,
                            op12_collocations, op13_quality_trees)}
