"""The corpus pipeline: every stage reads what its predecessor kept, written as Parquet and read again."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from furlong.llm import byte_bpe, mixing, quality
from furlong.llm.common import cut_lineage, load, prepare
from furlong.llm.exact_dedup import drop_equal_texts
from furlong.llm.simhash import drop_near_copies

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are more likely bad or toxic than not go."""
    prepare(spark)
    return quality.keep_good(docs, load(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays."""
    prepare(spark)
    return drop_equal_texts(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    prepare(spark)
    return drop_near_copies(docs, width=4, max_bits=4)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mix."""
    return mixing.mix(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether they decode to its text."""
    prepare(spark)
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    encoded = byte_bpe.encode_checked(docs, path, pattern)
    return encoded.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_filter),
    ("exact_dedup", exact_dedup),
    ("simhash_near_dedup", near_dedup),
    ("pfair_mixing", source_mix),
    ("byte_bpe", token_ids),
]

#: No SQL: fitted models, fingerprints and merges can't be expressed in it; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
