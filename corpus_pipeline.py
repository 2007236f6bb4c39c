"""From raw documents to packed training sequences, stage by stage.

Quality classifier, exact duplicates, near duplicates, secrets, packing.  Every
stage reads all that the one before kept, as Parquet in the shared folder, and its
decisions take effect; all but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from areaflow import session
from areaflow.llm import chunk_dedup, ngram_join, packing, quality, secret_scan


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier takes as good; fitted on four fifths of the labelled ones."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    fold = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 5 != 0
    return quality.keep_good(docs, quality.train(docs, labels, fold=fold))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return chunk_dedup.survivors(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.survivors(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality", keep_quality),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("secrets", redact_secrets),
    ("packing", pack),
]

# models and byte-pair merges are beyond SQL; tests hold the result against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs, _ = session.staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
