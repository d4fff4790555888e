"""Corpus preparation: quality rules, near duplicates, decontamination, BPE encoding.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame, which is written as Parquet and read again as the next
stage's documents. All but the last return the columns of the documents that they keep.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from actionwatch.llm import bpe_reuse, decontam, jaccard, quality
from actionwatch.llm.common import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the base rules or the share of content lines reject."""
    field = quality.train_field(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.keep_good(docs, field)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of equal or similar texts."""
    return jaccard.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item."""
    return decontam.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the documents left, and a digest of their decoding."""
    out = bpe_reuse.encode_documents(docs, tokenizer_path=public_tokenizers.path("word_bpe_49k.json"), decode=True)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("bpe_encoding", bpe_encoding)]

#: No SQL states the trained field's verdicts, nor the tokenizer's ids.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
