"""From raw documents to packed training sequences: rules, exact copies, near copies, mixture, packing."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from dockcast.llm import exact_dedup, mixing, packing, quality_rules, simhash
from dockcast.session import shared_dir

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the production policy rejects go."""
    return quality_rules.filter_documents(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays."""
    return exact_dedup.drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by SimHash (three words, two bits), the one with the smallest id stays."""
    return simhash.drop_near_copies(docs, simhash.SHINGLE, simhash.BUDGET)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it: not at all, or up to three times."""
    return mixing.mix_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in the sequences."""
    return packing.pack_documents(docs, TOKENIZER)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("exact_dedup", exact_copies),
    ("simhash_near_dedup", near_dedup),
    ("mixing", mixture),
    ("packing", packed),
]

#: SQL cannot express the fingerprints, the draws or the tokenizer; the tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written to the shared folder and read as the next one's input."""
    folder = f"{shared_dir(spark)}/dockcast/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
