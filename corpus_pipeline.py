"""Corpus preparation in five stages: toxicity, near duplicates, repeated passages, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.llm import mixing, ngram_join, packing, suffix_dedup, toxicity
from cardwatch.llm.common import table
from cardwatch.session import fresh_path, pin


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents rated toxic go; the model learns from the labelled ones among ``docs``."""
    rated = toxicity.rated(docs, table(spark, sf_dir, "labels"))
    return rated.filter(~F.col("toxic")).select(docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays."""
    return ngram_join.keep_one(docs)


def first_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of passages of 200 bytes or more that repeat, the first stays."""
    return suffix_dedup.deduplicated(docs)


def to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the targets of their sources ask for."""
    return mixing.mixed(docs)


def into_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens and their places in sequences."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", without_toxic),
    ("ngram_join", one_of_each),
    ("suffix_dedup", first_passages),
    ("mixing", to_weights),
    ("packing", into_sequences),
]

#: The trained model, the hash-keyed draw and the tokenizer have no SQL form; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, applied to all documents."""
    docs = table(pin(spark), sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
