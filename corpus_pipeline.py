"""A training corpus from raw documents, stage by stage; each stage is written and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from driftgate.llm import binpack, mixing, pii, quality, simhash
from driftgate.llm.common import cut
from driftgate.llm.queries import KEY

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.filter_documents(docs)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.keep_first(docs)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with pseudonyms for personal data."""
    return pii.pseudonymise(docs, KEY).select(*[f"`{c}`" for c in docs.columns])


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources mixed to their targets: what the mix takes of each document, once for each time round."""
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents packed into sequences of the permitted lengths."""
    return binpack.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", good),
    ("SimHash near-dedup", distinct),
    ("PII", private),
    ("mixing sources to target weights", mixed),
    ("best-fit packing", packed),
]

#: The language model and the random draws have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages, one after the other, over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir))
    return docs
