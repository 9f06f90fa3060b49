"""Corpus pipeline: quality rules, line dedup, near-duplicate removal, decontamination, BPE.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet to the shared
checkpoint folder and read again as the next stage's documents.  All stages but the last return the
columns of ``documents``; the last returns the token digests of what is left.

Defined results: the stages' own modules say what they do with nulls, empty texts and repeated
rows; an empty table passes through every stage as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import bpe, decontaminate, line_dedup, near_dedup, quality_rules
from quarry.llm.common import table, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.quality_filter(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.near_dedup(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.bpe_digest(docs, *bpe.default_vocabulary())


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("near_dedup", near),
    ("decontaminate", benchmark),
    ("byte_bpe", encode),
]

# Compression ratios, alignment, signatures and BPE merges have no SQL form: tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
