"""Connected components of a graph given by its edges."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.functions.skew import lookup_join
from tallyline.session import materialize

ROUNDS = 60  # rounds grow with the logarithm of the longest chain
ONE_TASK = 1_000_000  # edges (16 bytes each) up to which one task settles the rest


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges (a, b)`` that isn't the least of its component; ``root``
    is the least.

    Edges that fit a task by their count are settled in one. More of them go through alternating large-star
    and small-star rounds: each node's neighbours are hung under its least neighbour. Minima combine before
    the shuffle, no neighbour list is gathered, and the edges of a node with very many can be split in the
    joins."""
    links = materialize(_downward(edges))
    if links.count() <= ONE_TASK:
        return materialize(links.coalesce(1).mapInArrow(_settle, "node long, root long"))
    seen = _state(links)
    for _ in range(ROUNDS):
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = lookup_join(both, least, ["a"], "inner").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = lookup_join(large, lowest, ["a"], "inner").select(F.explode(F.array(
            F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b"))
        )).alias("e")).select("e.a", "e.b")
        links = materialize(_downward(small))
        now = _state(links)
        if now == seen:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = now
    raise RuntimeError(f"components did not settle in {ROUNDS} rounds")


def forest(size: int, one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """For each of ``size`` things the least one that the pairs connect it with."""
    root = np.arange(size)
    while True:
        a, b = root[one], root[other]
        apart = a != b
        if not apart.any():
            return root
        one, other, a, b = one[apart], other[apart], a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root = root[root]


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sides = [(np.array(batch.column(0)), np.array(batch.column(1))) for batch in batches]
    if sides:
        one, other = map(np.concatenate, zip(*sides))
        nodes, places = np.unique(np.concatenate([one, other]), return_inverse=True)
        root = forest(len(nodes), places[: len(one)], places[len(one) :])
        moved = np.flatnonzero(root != np.arange(len(nodes)))
        for at in range(0, len(moved), 100_000):
            part = moved[at : at + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(nodes[part]), pa.array(nodes[root[part]])], names=["node", "root"])


def _downward(edges: DataFrame) -> DataFrame:
    """Edges once each, the greater node first; loops are dropped."""
    return edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
