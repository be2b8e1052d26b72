"""Joins and rankings that stay balanced when one key holds a large share of the rows.

Joins leave the splitting to AQE and only take care that it can act. Rankings are windows, which AQE
cannot split, so heavy keys are looked for first, in a hash sample of the row ids. Their number is
bounded by the rows over ``hot_rows``. The list only steers the physical plan; every path returns the same, whole result.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyline.session import materialize


def lookup_join(rows: DataFrame, lookup: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join many rows to a lookup with one row per key (left, inner, left_semi or left_anti).

    A small lookup is broadcast by Spark's own size test. Otherwise both sides are shuffled and AQE
    splits heavy partitions of the rows. It does so only between two plain shuffles, and a lookup
    that was just aggregated by its key would skip its own; wrapping the key in a struct prevents
    that. Rows with a NULL key match nothing and are split like any heavy key.
    """
    for key in keys:
        lookup = lookup.where(F.col(key).isNotNull())
    keyed = lookup.withColumn("_key", F.struct(*keys)).drop(*keys)
    return rows.withColumn("_key", F.struct(*keys)).join(keyed, "_key", how).drop("_key")


@dataclass(frozen=True)
class SkewPolicy:
    hot_rows: int = 1_000_000  # a key with fewer rows is one ordinary task
    sample: int = 64  # one row id in `sample` is counted when looking for heavy keys


DEFAULT = SkewPolicy()


@dataclass(frozen=True)
class Hot:
    """Heavy keys that were looked for: a stored table of one column, or None when there are none."""

    table: DataFrame | None = None


def find_hot(rows: DataFrame, key: str, row_name: Sequence[str], policy: SkewPolicy = DEFAULT) -> Hot:
    """Look for heavy keys with one narrow job. All of them count; if there are any they are stored, not
    collected. ``row_name`` are the columns that name a row: a hash of all of them picks the sample."""
    seen = rows.where(F.col(key).isNotNull())
    if policy.sample > 1:
        seen = seen.where(F.pmod(F.xxhash64(*row_name), F.lit(policy.sample)) == 0)
    listed = (
        seen.groupBy(key)
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") * policy.sample >= policy.hot_rows)
        .select(key)
    )
    return Hot(None if listed.isEmpty() else materialize(listed))


def rank_rows(rows: DataFrame, key: str, order: Sequence[str], out: str = "k", hot: Hot = Hot()) -> DataFrame:
    """1-based position of each row within its key. ``order`` must be unique within the key."""
    plain = Window.partitionBy(key).orderBy(*order)
    if hot.table is None:
        return rows.withColumn(out, F.row_number().over(plain))
    listed = hot.table  # Spark broadcasts it by its own size test
    cold = rows.join(listed, key, "left_anti").withColumn(out, F.row_number().over(plain))
    return cold.unionByName(sliced_rank(rows.join(listed, key, "left_semi"), key, order, out))


def sliced_rank(rows: DataFrame, key: str, order: Sequence[str], out: str = "k") -> DataFrame:
    """Ranking for keys too large for one task.

    The rows are range-partitioned on (key, order), so a key is cut into consecutive slices; a
    position is the rows in earlier slices plus the position inside the slice. The slice numbers are
    materialized once, so that both uses of them agree even if an executor is lost.
    """
    slices = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sliced = materialize(
        rows.repartitionByRange(slices, key, *order).withColumn("_slice", F.spark_partition_id())
    )
    earlier = Window.partitionBy(key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    # one row per (key, slice), at most the number of listed keys plus the number of slices; Spark's own
    # size test decides on a broadcast
    starts = (
        sliced.groupBy(key, "_slice")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_start", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
        .select(key, "_slice", "_start")
    )
    inside = Window.partitionBy(key, "_slice").orderBy(*order)
    return (
        sliced.withColumn(out, F.row_number().over(inside))
        .join(starts, [key, "_slice"])
        .withColumn(out, (F.col(out) + F.col("_start")).cast("int"))
        .drop("_slice", "_start")
    )


def hot_on_either_side(
    rows: DataFrame, slots: DataFrame, key: str, row_name: Sequence[str], slot_name: Sequence[str],
    policy: SkewPolicy = DEFAULT,
) -> Hot:
    """Keys that are heavy counting both sides together."""
    both = rows.select(key, F.xxhash64(*row_name).alias("_id")).unionByName(
        slots.select(key, F.xxhash64(*slot_name).alias("_id"))
    )
    return find_hot(both, key, ["_id"], policy)


def pair_by_rank(
    rows: DataFrame, slots: DataFrame, key: str, row_order: Sequence[str], slot_order: Sequence[str], hot: Hot = Hot()
) -> DataFrame:
    """Give the k-th row of every key the k-th slot of that key; surplus rows get NULL slot columns.

    Besides ``key`` the two sides must not share column names.
    """

    def pair(r: DataFrame, s: DataFrame, rank) -> DataFrame:
        return rank(r, key, row_order).join(rank(s, key, slot_order), [key, "k"], "left")

    if hot.table is None:
        return pair(rows, slots, rank_rows)
    listed = hot.table  # Spark broadcasts it by its own size test
    cold = (df.join(listed, key, "left_anti") for df in (rows, slots))
    warm = (df.join(listed, key, "left_semi") for df in (rows, slots))
    return pair(*cold, rank_rows).unionByName(pair(*warm, sliced_rank))
