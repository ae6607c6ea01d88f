"""A training corpus in five stages: toxic documents go, exact and near copies go, sources are mixed, and what is left is packed.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again
as the next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from millrace.llm import exact, jaccard, mixing, packing, toxicity
from millrace.llm.common import scratch, stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents with a toxicity score of 0.3 or more."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document for each text, white space aside."""
    return exact.drop_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group that five-word shingles link at a similarity of 0.8 or more."""
    return jaccard.one_of_each_group(docs, size=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each document as often as its source's target asks for; repeats are rows of their own."""
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places every document's pieces in sequences of 2048 ids."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("ngram_jaccard_join", drop_near_copies),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

#: Trained models and tokenizers cannot be told in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each result written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), scratch(spark, f"stage-{name}"))
    return docs
