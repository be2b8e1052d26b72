"""Small helpers the corpus operators share."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.session import shared_folder

# White space of the corpus tables: space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """The rows written once to the shared folder, packed tighter than usual, and read back."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/tallyline/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def whole(column: str | Column) -> Column:
    """The whole text, a null one as the empty text."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def words_of(text: Column) -> Column:
    """Words as an array: the pieces between white space."""
    return F.filter(F.split(text, BLANKS, -1), lambda word: word != "")


def folded_fraction(column: Column) -> Column:
    """crc32 of the id as text modulo 5: 0 marks the held-out fold (null ids are held out)."""
    return F.coalesce(F.crc32(column.cast("string")) % 5, F.lit(0))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, limit: int) -> DataFrame:
    """``rank, text, label`` of at most ``limit`` labelled documents outside the held-out fold, picked by
    a hash of their ids. Labels that are null or contradict each other are left out, as are labels of
    documents that don't exist; a repeated document counts once."""
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & (folded_fraction(F.col("doc_id")) != 0))
        .groupBy(F.col("doc_id").alias("_id"))
        .agg(F.min(label).alias("label"), F.max(label).alias("_most"))
        .where(F.col("label") == F.col("_most"))
    )
    picked = known.orderBy(F.xxhash64("_id"), "_id").limit(limit).select("_id", F.col("label").cast("int").alias("label"))
    found = docs.select("doc_id", whole("text").alias("text")).join(F.broadcast(picked), F.col("doc_id") == F.col("_id"))
    return found.dropDuplicates(["_id"]).select(F.xxhash64("_id").alias("rank"), "text", "label")
