"""From raw documents to token ids, in five stages.

Each stage reads what its predecessor wrote as Parquet, works on all of it, and
its decisions take effect: rejected documents go, one document of each group
of near-duplicates stays, secrets are replaced, documents repeat as the mix
takes them, and what is left is encoded.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.llm import bpe, credentials, mixing, quality, simhash
from panelwright.llm.common import table
from panelwright.session import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the trees keep."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one with the smallest id."""
    return simhash.one_of_each(docs, shingle=4, distance=4)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with secrets replaced; n_chars follows the text."""
    clean = credentials.redact(docs)
    return clean.withColumn("n_chars", F.coalesce(F.length("text").cast(clean.schema["n_chars"].dataType), F.col("n_chars")))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, token_ids, n_tokens and whether the ids decode to the text."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return bpe.encode_and_check(docs, path, ["doc_id", "source"])


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("secret_scan", secret_scan),
    ("source_mix", source_mix),
    ("encode", encode),
]

#: Trees, XXH64, guess costs and merges are not expressible in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
