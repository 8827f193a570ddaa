"""A corpus pipeline: filter, deduplicate at three levels, pack.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last return the
columns of ``docs``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concordat.llm import line_dedup, near_dedup, packing, quality_classifier, substring_dedup
from concordat.llm.shared import saved


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject, learnt from the labels of ``sf_dir``."""
    return quality_classifier.keep(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that are similar to an earlier line."""
    return line_dedup.clean(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return near_dedup.keep_first(docs)


def drop_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 50 words that an earlier document holds."""
    return substring_dedup.clean(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 1024 tokens."""
    pieces = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality classifier", classify),
    ("line dedup", drop_lines),
    ("near dedup", drop_copies),
    ("substring dedup", drop_passages),
    ("packing", pack),
]

#: No SQL expresses the classifier, the samples or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
