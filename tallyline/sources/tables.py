"""Table and line readers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.functions.skew import lookup_join
from tallyline.session import materialize


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    properties: dict[str, str] | None = None,
    partition_column: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """A database table; give a numeric partition column and its bounds to read it in parallel."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**(properties or {}))
    if partition_column is not None:
        if lower is None or upper is None or partitions is None:
            raise ValueError("a partition column needs lower, upper and partitions")
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", lower)
            .option("upperBound", upper)
            .option("numPartitions", partitions)
        )
    return reader.load()


# A line id is file number | line number, so it is unique over all files of a staging table, follows the order
# of the file and does not depend on how the file was split over tasks.
_FILE_BITS = 55
FILE_NUMBERS = 1 << (63 - _FILE_BITS)  # from 0 on


def _line_id(file_no: Column, line: Column) -> Column:
    return F.shiftleft(file_no.cast("bigint"), _FILE_BITS) + line


def read_lines(spark: SparkSession, path: str, file_no: int = 0, whole_files: bool = False) -> DataFrame:
    """Text files as ``(id, FileName, value)``; lines are numbered from 1 in each file.

    Large files are split over tasks. The lines are stored with the split they come from and their place in
    it; a line's number is the lines of all earlier splits of its file plus its place. Only one row per
    split is summed up in order. ``whole_files`` reads each (small) file whole and stores nothing.
    """
    if not 0 <= file_no < FILE_NUMBERS:
        raise ValueError(f"file number {file_no} is not in 0..{FILE_NUMBERS - 1}: its line ids would repeat another file's")
    number = F.lit(file_no)
    if whole_files:
        texts = spark.read.text(path, wholetext=True).select(
            F.col("_metadata.file_name").alias("FileName"),
            # the piece after the last line break is no line
            # and a byte-order mark is no character of the first
            F.split(F.regexp_replace("value", "^\uFEFF|(\r\n|\n|\r)$", ""), "\r\n|\n|\r").alias("texts"),
        )
        listed = texts.select("FileName", F.posexplode("texts").alias("pos", "value"))
        return listed.select(_line_id(number, F.col("pos") + 1).alias("id"), "FileName", "value")
    # Numbers of a task's rows rise by one; a split lies in one task, though a task may have several.
    read = materialize(
        spark.read.text(path).select(
            F.col("_metadata.file_path").alias("_path"),
            F.col("_metadata.file_name").alias("FileName"),
            F.col("_metadata.file_block_start").alias("_split"),
            F.monotonically_increasing_id().alias("_place"),
            "value",
        )
    )
    splits = read.groupBy("_path", "_split").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_lines"))
    earlier = Window.partitionBy("_path").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.select(
        "_path", "_split", (F.coalesce(F.sum("_lines").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_shift")
    )
    rows = lookup_join(read, starts, ["_path", "_split"], "inner")
    return rows.select(_line_id(number, F.col("_place") + F.col("_shift")).alias("id"), "FileName", "value")
