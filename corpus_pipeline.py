"""A training corpus from documents: language, exact and near copies, mixture, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its rows are written and
read again as the next stage's documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from rollforward.llm import exact_dedup, language_id, minhash, mixing, packing
from rollforward.llm.common import stage, table
from rollforward.llm.queries import TOKENIZER, checksum_of_id, new_index


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or without a language that is likelier than not, go."""
    model = language_id.fit(docs.filter(checksum_of_id(3) != 1))
    return language_id.keep_identified(docs, model)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one stays."""
    return exact_dedup.drop_copies(docs, new_index(spark), "documents")


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five-word shingles, similarity 0.8) one stays."""
    return minhash.drop_near_copies(docs, k=5, percent=80)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights; a document may be taken up to three times."""
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 4096 tokens."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identified),
    ("exact_dedup", without_copies),
    ("minhash_near_dedup", without_near_copies),
    ("source_mixing", mixed),
    ("packing", packed),
]

ORACLE_SQL = None  # language scores, MinHash and tokens are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs
