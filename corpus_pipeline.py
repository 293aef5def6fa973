"""The training-data pipeline over the table of documents.

``STAGES`` in order: quality rules reject documents, near-duplicate groups
keep one document each, personal data is masked, sources are mixed to their
weights (a document stands once for each time the mix takes it), and the
texts become tokens. Each function takes (spark, docs, sf_dir) and returns a
DataFrame; all but the last keep the columns of ``docs``. ``run`` writes each
stage as Parquet to the shared checkpoint folder and reads it again as the
next one's input, so a lost executor costs no earlier stage.

Each stage has a defined result for null, empty, repeated and no rows: see the
operators' modules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shopcast.llm import byte_bpe, fertility, hyperminhash, mixing, pii
from shopcast.llm.common import shared


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the fertility bands."""
    return fertility.accepted(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return hyperminhash.deduplicate(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind, ``n_chars`` counted anew."""
    return pii.redact(docs, length_col="n_chars" if "n_chars" in docs.columns else None)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mix(docs)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and digests of ids and decoded bytes."""
    return byte_bpe.encode_digest(docs)


STAGES = [("quality_rules", quality_rules), ("near_dedup", near_dedup), ("mask_personal_data", mask_personal_data),
          ("mix_sources", mix_sources), ("encode_texts", encode_texts)]

#: Tokenizers, near-duplicate search and hash order are beyond SQL; tests hold
#: the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = shared(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
