"""Session settings the operators are designed for."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings. Shuffle partition counts, memory and executors belong to the cluster and
# are left alone; AQE sizes the partitions.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Heavy join partitions are split, even where that costs another shuffle later.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A join on (policy, rank) may reuse the partitioning on policy that the ranking windows left.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # Reloading one file replaces only that file's staging partition.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SQL_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only where none is named (local runs and tests) a temporary one is used.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return _local_folder()


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="tallyline-")


def materialize(df: DataFrame) -> DataFrame:
    """Write the rows once to the shared folder and read them back: cuts the lineage and survives lost
    executors, and later steps read only the columns they need."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/tallyline/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
