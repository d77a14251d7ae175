"""From raw documents to token digests, one operator after the other.

Each stage reads what its predecessor kept, as a written table, and returns the
columns of ``documents``; the last one returns the digests.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from changeflow.llm import digest_index, jaccard_join, mixing, piece_codec, quality_model
from changeflow.llm.tables import written

#: Words that a worker keeps encoded.
CACHE_WORDS = 30_000


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_model.keep_good(docs, labels, metadata=["n_chars"])


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest id stays."""
    return digest_index.keep_first_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by similar sets of five-word shingles the smallest id stays."""
    return jaccard_join.keep_one_of_each(docs, percent=80, k=5)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mixture of their sources."""
    return mixing.in_mixed_order(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the ids and of the decoded text of every document.

    Few words are kept: the workers live beside a heap that the stages before have filled.
    """
    return piece_codec.piece_digests(docs, public_tokenizers.path("piece_bpe_32k.model"), cache_words=CACHE_WORDS)


STAGES = [
    ("quality", drop_low_quality),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix),
    ("encode", encode),
]

#: Model scores, similarities and vocabularies have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
