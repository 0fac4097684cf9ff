"""From raw documents to packed training sequences.

Each stage is a function of (spark, docs, sf_dir); its result is written as Parquet and read again
as the next stage's documents. All but the last return the columns of the documents table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm import packing, pii, quality, shingles, simhash, toxicity
from touchline.llm.common import table
from touchline.session import stage

#: The last stage's tokenizer.
WORDS = "word_bpe_49k.json"


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from the labels of these documents."""
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels"), F.lit(True)))


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier accepts."""
    return toxicity.keep_clean(docs, toxicity.train(docs, table(spark, sf_dir, "labels"), F.lit(True)))


def single(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, linked in either way or through others: SimHash fingerprints that differ
    in four bits or fewer, and texts whose five-word shingles have a Jaccard similarity of 0.8 or more."""
    return shingles.without_copies(docs, simhash.grouped(docs))


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without personal data."""
    return pii.sanitised(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 4096 tokens."""
    return packing.pack(docs, packing.read_definition(public_tokenizers.path(WORDS)))


STAGES = [("quality", good), ("toxicity", clean), ("near_duplicates", single), ("personal_data", private), ("packing", packed)]

#: The classifiers, the fingerprints and the tokenizer are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
