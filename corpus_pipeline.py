"""Documents to packed training sequences, in stages that each read what the one before kept."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from dropsieve.llm import langid, minhash, packing, rules, substring
from dropsieve.llm.common import table
from dropsieve.session import shared_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that no quality rule rejects."""
    return rules.passing(docs)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the texts of a language; all given labels of ``docs`` are learned from."""
    return langid.accepted(docs, langid.fit(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group linked by a similarity of 0.8 on five-word shingles."""
    return minhash.deduplicated(docs, width=5, percent=80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages of 50 words and more that a document of smaller id has too."""
    return substring.deduplicated(docs, length=50)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs all documents into sequences of 2,048 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("language ID", language),
    ("MinHash near-dedup", near_duplicates),
    ("substring dedup", repeated_passages),
    ("best-fit packing", pack_sequences),
]

ORACLE_SQL = None  # tokenizing and packing are not SQL; tests compare with a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; each result is stored and read by the next stage."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = f"{shared_dir(spark)}/{name.replace(' ', '-')}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
