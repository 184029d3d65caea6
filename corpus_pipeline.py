"""A corpus pipeline: five stages over documents, each written as Parquet and read by the next.

A stage takes (spark, docs, sf_dir) and works on all rows of ``docs``. All but the last return the
columns of ``docs``; what they do with nulls, ties, repeated rows and empty tables is said at the operators
that they call.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodestar.llm import (
    bitsliced_simhash, pii_boosting, positional_index, quality_rules, residual_packing,
)
from lodestar.llm.common import stored
from lodestar.llm.queries import byte_bpe


def rule_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and every certified cutoff of their language."""
    return quality_rules.kept(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of fingerprints at two bits or fewer."""
    return bitsliced_simhash.first_of_each_component(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    return positional_index.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return pii_boosting.redacted(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences of 2048 ids."""
    return residual_packing.packed_sequences(docs, byte_bpe())


STAGES = [
    ("quality_rules", rule_filter),
    ("simhash_near_dedup", near_copies),
    ("benchmark_decontamination", decontaminate),
    ("pii_redaction", redact),
    ("best_fit_packing", pack),
]

# signatures, boosted trees, tokens and packing have no SQL; tests hold the stages to brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the table documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
