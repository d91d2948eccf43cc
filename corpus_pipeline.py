"""From raw documents to encoded training text, in stages that each call one operator.

Every stage is written as Parquet to the shared folder and read back, so a lost executor costs no more
than its own tasks of the running stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from salesloom.llm.byte_bpe import encoding_digests
from salesloom.llm.exact_dedup import drop_exact_duplicates
from salesloom.llm.mixing import apply_mix
from salesloom.llm.near_dedup import drop_near_duplicates
from salesloom.llm.perplexity import drop_low_quality
from salesloom.session import stage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality rules keep."""
    return drop_low_quality(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each group of equal texts."""
    return drop_exact_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares four fifths of its five-word shingles."""
    return drop_near_duplicates(docs, width=5)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them: once, twice or not at all."""
    return apply_mix(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the bytes they decode to."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return encoding_digests(docs.select("doc_id", "source", "text"), path, public_tokenizers.PATTERN)


STAGES = [
    ("quality_rules", quality),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("mixing", mixed),
    ("byte_bpe", encoded),
]

#: The language model, the entropy balancing and the merges have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs
