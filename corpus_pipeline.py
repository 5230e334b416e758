"""The corpus pipeline: quality classifier, exact dedup, near dedup, source mix, BPE encoding and decoding.

Each stage takes (spark, docs, sf_dir) and returns the columns of ``documents``; the last returns the tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillmill.llm import bpe, exact_dedup, mixing, near_dedup, quality
from quillmill.llm.common import saved


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest id stays."""
    return exact_dedup.dedup_exact(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays."""
    return near_dedup.dedup_near(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training stream: documents as often as their source's target takes them, in the order of training."""
    return mixing.mix(docs)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, ids of every document of the stream."""
    return bpe.digests(docs, with_ids=True)


STAGES = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_stage),
    ("near dedup", near_stage),
    ("source mix", mix_stage),
    ("bpe", bpe_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for nr, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs if nr == 0 else saved(docs, "stage"), sf_dir)
    return docs


#: Signatures, trees and tokens are beyond SQL; tests hold each stage against a plain version.
ORACLE_SQL = None
