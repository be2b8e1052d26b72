"""From raw documents to token ids, one stored stage after another."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tallyline.llm import decontaminate, jaccard_join, piece_tokens, quality_rules, secret_scan
from tallyline.llm.queries import piece_model
from tallyline.session import shared_folder


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.keep_good(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return jaccard_join.keep_one(docs)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, or most of one, go."""
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the texts; all documents stay."""
    return secret_scan.redact(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with their count and digests."""
    return piece_tokens.encode(docs, piece_model(), with_ids=True)


STAGES = [
    ("quality_rules", quality),
    ("jaccard_join", near_copies),
    ("decontaminate", leaks),
    ("secret_scan", secrets),
    ("piece_tokens", tokens),
]

# Distances, sampled paths and tokenizer merges have no SQL form; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written to the shared folder and reread."""
    folder = f"{shared_folder(spark)}/tallyline/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
