"""N-gram Jaccard join by chosen paths.

Texts are sets of 5-word shingles (a text of fewer words is one shingle). Equal sets are one node; each
node has a sketch of minimum hashes, whose equal places estimate the similarity of two sets. A run hashes
nodes down a random tree: at every level a path samples one or two places of the sketch (1.25 on the
average, 1 / 0.8), and nodes with the same values there go on together. Nodes that share a path are
compared exactly:

* buckets of at most ``BUCKET`` nodes by brute force,
* larger ones are split ``SPLIT`` levels deeper; what is still large then is a family of like texts. The
  nodes of a family are compared whole, block with block, so no pair in it depends on chance.

Before shingle sets travel, the nodes of a bucket are compared by the low bytes of their sketches. Only those go
on that agree with a node of another class in ``NEAR`` places or more, which a linked pair misses with a chance
of 1e-12 at most. Where buckets share such nodes, all nodes they connect are compared whole if that sends fewer
sets than comparing bucket by bucket.

Runs are repeated until a pair at the threshold is met with probability ``RECALL``, counting that all runs
sample the same sketch, in which more or fewer places than the similarity says may agree. What the first runs
link forms classes; later runs compare buckets that hold nodes of several classes. Links inside a class
are then counted exactly, again block with block.
"""

from __future__ import annotations

import hashlib
import itertools
import math
import re
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import whole
from tallyline.llm.components import components, forest
from tallyline.session import materialize

WIDTH = 5  # words of a shingle
PLACES = 128  # of a sketch
BUCKET = 128  # nodes compared by brute force
BLOCK = 128  # nodes of a family or class compared with as many others at a time
DEPTH = 3  # levels all nodes descend
SPLIT = 3  # further levels of large buckets
RECALL = 0.99999
FIRST_RUNS = 3  # what these link need not be compared by the later ones
BROADCAST_NODES = 1_000_000  # wanted nodes (24 bytes each) up to which they are sent to every task
WORD = re.compile(r"[^\x20\x09-\x0D]+")
KNOWN_WORDS = 100_000  # hashes a task remembers
MIX = np.uint64(0x9E3779B97F4A7C15)
MIX2 = np.uint64(0xBF58476D1CE4E5B9)
MIX3 = np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit mix of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * MIX2
    x = (x ^ (x >> np.uint64(27))) * MIX3
    return x ^ (x >> np.uint64(31))


class Hashes(dict):
    """Word -> 64-bit hash, remembered for a bounded number of words."""

    def __missing__(self, word: str) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        value = self[word] = int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "little")
        return value


def shingles(text: str, hashes: Hashes) -> np.ndarray:
    """The sorted set of hashes of the text's shingles; empty without words."""
    words = np.fromiter(map(hashes.__getitem__, WORD.findall(text)), dtype=np.uint64)
    n = max(len(words) - WIDTH + 1, min(len(words), 1))
    if not n:
        return words
    found = np.zeros(n, dtype=np.uint64)
    for k in range(min(WIDTH, len(words))):
        found = mixed(found * MIX + words[k : k + n] + np.uint64(k + 1))
    return np.unique(found)


def sketch(shingle_set: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """The least product of the set's hashes (their upper halves) with each odd factor, modulo 2^32."""
    upper = (shingle_set >> np.uint64(32)).astype(np.uint32)
    low = np.full(len(factors), np.iinfo(np.uint32).max, dtype=np.uint32)
    for at in range(0, len(upper), 256):
        low = np.minimum(low, (upper[at : at + 256, None] * factors).min(axis=0))
    return low


def factors() -> np.ndarray:
    return (mixed(np.arange(1, PLACES + 1, dtype=np.uint64) * MIX) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def missed(depth: int, similarity: float = 0.8) -> float:
    """Chance that a pair shares no path of one run: it stays together at each sampled place with the
    similarity's probability, and a path samples a second place a quarter of the times."""
    lost = 0.0
    for _ in range(depth):
        apart = 1 - similarity + similarity * lost
        lost = 0.75 * apart + 0.25 * apart**2
    return lost


def runs_needed(depth: int = DEPTH + SPLIT, recall: float = RECALL) -> int:
    """The trees are fixed, and single ones were seen to miss twice their mean, so half the chance is asked for."""
    runs = 1
    while missed_by_all(runs, depth) > (1 - recall) / 2:
        runs += 1
    return runs


def missed_by_all(runs: int, depth: int, similarity: float = 0.8) -> float:
    """Chance that a pair shares no path of any run. The runs sample one sketch, so it is the mean over how
    many of its places agree."""
    return sum(
        math.comb(PLACES, k) * similarity**k * (1 - similarity) ** (PLACES - k) * missed(depth, k / PLACES) ** runs
        for k in range(PLACES + 1)
    )


def descend(paths: np.ndarray, owner: np.ndarray, sketches: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Children of the paths: each samples one or two places by its own hash and adds their values."""
    draw = mixed(paths ^ MIX)
    first = (draw % np.uint64(PLACES)).astype(np.int64)
    second = ((draw >> np.uint64(16)) % np.uint64(PLACES)).astype(np.int64)
    twice = ((draw >> np.uint64(40)) % np.uint64(4) == 0) & (second != first)

    def child(place: np.ndarray, paths: np.ndarray, owner: np.ndarray) -> np.ndarray:
        value = sketches[owner, place].astype(np.uint64)
        return mixed(paths * MIX2 + mixed(value * MIX + place.astype(np.uint64) + np.uint64(1)))

    children = [child(first, paths, owner), child(second[twice], paths[twice], owner[twice])]
    return np.concatenate(children), np.concatenate([owner, owner[twice]])


def least_agreeing(chance: float = 1e-12, similarity: float = 0.8) -> int:
    """The most places such that a pair of this similarity agrees in fewer of them with the chance at most."""
    below, places = 0.0, -1
    while below <= chance:
        places += 1
        below += math.comb(PLACES, places) * similarity**places * (1 - similarity) ** (PLACES - places)
    return places


NEAR = least_agreeing()


def near_groups(briefs: np.ndarray, classes: np.ndarray) -> list[np.ndarray]:
    """Places of the sketches (low bytes) that agree with one of another class in ``NEAR`` places or more,
    grouped by what such agreements connect."""
    agreeing = np.zeros((len(briefs), len(briefs)), dtype=np.int32)
    for at in range(0, len(briefs), 64):
        agreeing[at : at + 64] = (briefs[at : at + 64, None] == briefs[None]).sum(axis=2)
    one, other = np.nonzero((agreeing >= NEAR) & (classes[:, None] != classes[None, :]))
    root = forest(len(briefs), one, other)
    return [np.flatnonzero(root == r) for r in np.unique(root[one])]


# --- tasks -----------------------------------------------------------------------------------


def _sketcher() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, own = Hashes(), factors()
        for batch in batches:
            names, sizes, sketches = [], [], []
            for text in batch.column(3):
                found = shingles(text.as_py(), hashes)
                names.append(hashlib.md5(found.tobytes()).hexdigest())
                sizes.append(len(found))
                sketches.append(sketch(found, own).tobytes())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(3)), pa.array(names), pa.array(sizes, pa.int32()), pa.array(sketches, pa.binary())],
                names=["row", "doc_id", "key", "name", "n", "sketch"],
            )

    return run


def _walker(runs: range, depth: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = np.array(batch.column(0))
            sketches = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype=np.uint32).reshape(-1, PLACES)
            for number in runs:
                owner = np.arange(len(nodes))
                paths = np.full(len(nodes), mixed(np.array([number + 1], dtype=np.uint64) * MIX)[0])
                for _ in range(depth):
                    paths, owner = descend(paths, owner, sketches)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(paths.view(np.int64)), pa.array(nodes[owner])], names=["path", "node"]
                )

    return run


def _deeper(levels: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = np.array(batch.column(1))
            sketches = np.frombuffer(b"".join(batch.column(2).to_pylist()), dtype=np.uint32).reshape(-1, PLACES)
            paths, owner = np.array(batch.column(0)).view(np.uint64), np.arange(len(nodes))
            for _ in range(levels):
                paths, owner = descend(paths, owner, sketches)
            yield pa.RecordBatch.from_arrays([pa.array(paths.view(np.int64)), pa.array(nodes[owner])], names=["path", "node"])

    return run


def _briefs() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The low byte of every place of a sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.frombuffer(held.as_py(), dtype=np.uint32).astype(np.uint8).tobytes() for held in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["node", "brief"])

    return run


def _near() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The nodes of each bucket that need an exact comparison, in buckets named by their nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches):
            nodes, classes = (np.array([row[k] for row in group], dtype=np.int64) for k in (1, 3))
            briefs = np.frombuffer(b"".join(row[2] for row in group), dtype=np.uint8).reshape(-1, PLACES)
            for places in near_groups(briefs, classes):
                name = hashlib.blake2b(nodes[places].tobytes(), digest_size=8).digest()
                bucket = np.full(len(places), int.from_bytes(name, "little", signed=True))
                yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(nodes[places])], names=["bucket", "node"])

    return run


def _sets() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                found = [shingles(text.as_py(), hashes).tobytes() for text in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.binary())], names=["node", "shingles"])

    return run


def linked(sets: list[np.ndarray]) -> np.ndarray:
    """Matrix of which sets have a Jaccard similarity of at least 0.8, exactly: shared shingles are
    counted by products of blocks of the incidence matrix."""
    m = len(sets)
    sizes = np.array(list(map(len, sets)))
    both = np.zeros((m, m))
    if m == 2:
        both[0, 1] = both[1, 0] = len(np.intersect1d(*sets, assume_unique=True))
    else:
        owner = np.repeat(np.arange(m), sizes)
        _, where, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        shared = times[where] > 1
        owner, column = owner[shared], where[shared]
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], np.cumsum(np.diff(column[order], prepend=-1) != 0) - 1
        width = 1 << 14
        for at in range(0, int(column[-1]) + 1 if len(column) else 0, width):
            a, b = np.searchsorted(column, [at, at + width])
            held = np.zeros((m, min(width, int(column[-1]) + 1 - at)), dtype=np.float32)
            held[owner[a:b], column[a:b] - at] = 1
            both += held @ held.T
    # I / (a + b - I) >= 4 / 5
    match = (9 * both >= 4 * (sizes[:, None] + sizes[None, :])) & (sizes[:, None] > 0)
    np.fill_diagonal(match, False)
    return match


def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows of each value of the first column, which they come ordered by, without repeated nodes."""
    parts = (batch.slice(at, 200) for batch in batches for at in range(0, batch.num_rows, 200))
    rows = (row for part in parts for row in zip(*(column.to_pylist() for column in part.columns)))
    for _, found in itertools.groupby(rows, key=lambda row: row[0]):
        yield sorted({row[1]: row for row in found}.values(), key=lambda row: row[1])


def _forests() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Per group edges that connect what its links connect: each node and the least one it goes with."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches):
            match = linked([np.frombuffer(row[2], dtype=np.uint64) for row in group])
            root = np.arange(len(group))
            for i in range(len(group)):
                near = np.flatnonzero(match[i, :i])
                if len(near):
                    roots = np.unique(root[near])
                    root[np.isin(root, roots)] = roots[0]
                    root[i] = roots[0]
            found = np.flatnonzero(root != np.arange(len(group)))
            if len(found):
                nodes = np.array([row[1] for row in group])
                yield pa.RecordBatch.from_arrays([pa.array(nodes[found]), pa.array(nodes[root[found]])], names=["a", "b"])

    return run


def _link_counts() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Per node the documents it links in a pair of blocks. Pairs inside a block count in the pair of the
    block with itself alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches):
            match = linked([np.frombuffer(row[2], dtype=np.uint64) for row in group])
            nodes, copies, block = (np.array([row[k] for row in group]) for k in (1, 3, 4))
            if group[0][5] != group[0][6]:
                match &= block[:, None] != block[None, :]
            links = match @ copies
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes[links > 0]), pa.array(links[links > 0].astype(np.int64))], names=["node", "links"]
            )

    return run


# --- plan ------------------------------------------------------------------------------------


class Join:
    """One join: the documents, their nodes and the classes that the links found so far make."""

    def __init__(self, docs: DataFrame):
        self.docs = docs.select("doc_id", whole("text").alias("text"), F.xxhash64(whole("text")).alias("key"))
        kind = docs.schema["doc_id"].dataType.simpleString()
        # Rows get a number when their sketches are stored; it tells rows of equal or no id apart.
        self.rows = materialize(
            self.docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "key", "text").mapInArrow(
                _sketcher(), f"row long, doc_id {kind}, key long, name string, n int, sketch binary"
            )
        )
        self.nodes = materialize(
            self.rows.where("n > 0").groupBy("name").agg(
                F.min(F.struct("row", "doc_id", "key")).alias("first"), F.count("*").alias("copies"),
                F.min("doc_id").alias("least_id"), F.first("sketch").alias("sketch"),
            ).select("first.row", "first.doc_id", "first.key", "name", "copies", "least_id", "sketch")
            .withColumnRenamed("row", "node")
        )
        self.roots = None  # node, root

    def run(self) -> None:
        last = runs_needed()
        for runs in (range(FIRST_RUNS), range(FIRST_RUNS, last)):
            self.search(runs)

    def search(self, runs: range) -> None:
        """Find links of the nodes that meet in these runs."""
        paths = self.nodes.select("node", "sketch").mapInArrow(_walker(runs, DEPTH), "path long, node long")
        members = materialize(self.undecided(paths))
        met = [self.small(members)]
        hot = members.where(F.col("size") > BUCKET)
        if not hot.isEmpty():
            rows = hot.select("path", "node").join(self.nodes.select("node", "sketch"), "node")
            split = rows.select("path", "node", "sketch").mapInArrow(_deeper(SPLIT), "path long, node long")
            members = materialize(self.undecided(split))
            met += [self.small(members), self.families(members.where(F.col("size") > BUCKET))]
        near = materialize(self.near(reduce(DataFrame.unionByName, met).distinct()))
        if near.isEmpty():
            return
        buckets = materialize(fewest(near))
        held = buckets.join(self.sets_of(buckets), "node").select("bucket", "node", "shingles")
        edges = materialize(together(held).mapInArrow(_forests(), "a long, b long"))
        self.roots = components(edges if self.roots is None else edges.unionByName(self.roots.toDF("a", "b")))

    def undecided(self, paths: DataFrame) -> DataFrame:
        """``path, node, size`` of buckets that hold nodes of two classes or more."""
        crowded = paths.groupBy("path").agg(F.count("*").alias("size")).where("size > 1")
        rows = paths.join(crowded, "path")
        if self.roots is None:
            return rows
        classed = rows.join(self.roots, "node", "left").withColumn("class", F.coalesce("root", "node"))
        mixed_ones = classed.groupBy("path").agg(F.min("class").alias("lo"), F.max("class").alias("hi")).where("lo != hi")
        return classed.join(mixed_ones, "path", "left_semi").select("path", "node", "size")

    def small(self, members: DataFrame) -> DataFrame:
        """``bucket, node`` of the buckets that are compared whole; those of the same nodes are one."""
        listed = members.where(F.col("size") <= BUCKET).groupBy("path").agg(F.sort_array(F.collect_list("node")).alias("nodes"))
        once = listed.select(F.xxhash64("nodes").alias("bucket"), "nodes").dropDuplicates(["bucket"])
        return once.select("bucket", F.explode("nodes").alias("node"))

    def families(self, members: DataFrame) -> DataFrame:
        """``bucket, node`` of the pairs of blocks of the families: nodes that large buckets connect."""
        roots = connected(members, "path")
        nodes = roots.select("node", F.col("root").alias("group")).unionByName(
            roots.select(F.col("root").alias("node"), F.col("root").alias("group")).distinct()
        )
        return block_pairs(nodes).select("bucket", "node")

    def near(self, buckets: DataFrame) -> DataFrame:
        """``bucket, node`` of what has to be compared exactly, as the sketches tell."""
        if self.roots is None:
            classed = buckets.withColumn("class", F.col("node"))
        else:
            classed = buckets.join(self.roots, "node", "left").withColumn("class", F.coalesce("root", "node"))
        briefs = self.nodes.select("node", "sketch").mapInArrow(_briefs(), "node long, brief binary")
        rows = classed.join(briefs, "node").select("bucket", "node", "brief", "class")
        return together(rows).mapInArrow(_near(), "bucket long, node long").distinct()

    def sets_of(self, wanted: DataFrame) -> DataFrame:
        """``node, shingles`` of the wanted nodes, from the texts."""
        wanted = materialize(
            self.nodes.select("node", "doc_id", "key").join(wanted.select("node").distinct(), "node", "left_semi")
        )
        keys = wanted.select("node", F.col("doc_id").alias("_id"), F.col("key").alias("_key"))
        if wanted.count() <= BROADCAST_NODES:
            keys = F.broadcast(keys)
        texts = self.docs.join(keys, (F.col("key") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_id")))
        return texts.select("node", "text").mapInArrow(_sets(), "node long, shingles binary")

    def classes(self) -> DataFrame:
        """``node, class, copies, least_id`` of all nodes."""
        nodes = self.nodes.select("node", "copies", "least_id")
        if self.roots is None:
            return nodes.withColumn("class", F.col("node"))
        return nodes.join(self.roots, "node", "left").withColumn("class", F.coalesce("root", "node")).drop("root")

    def links(self, classes: DataFrame) -> DataFrame:
        """``node, links``: documents of other sets each node links. Every pair of a class is compared
        once, in the pair of blocks it falls in."""
        several = classes.groupBy("class").agg(F.count("*").alias("n")).where("n > 1").select("class")
        inside = classes.join(several, "class").select("node", "copies", F.col("class").alias("group"))
        placed = materialize(block_pairs(inside))
        held = placed.join(self.sets_of(placed), "node").select(
            "bucket", "node", "shingles", "copies", "block", "one", "other"
        )
        counted = together(held).mapInArrow(_link_counts(), "node long, links long")
        return counted.groupBy("node").agg(F.sum("links").alias("links"))


def block_pairs(nodes: DataFrame) -> DataFrame:
    """``nodes`` (``node, group`` and more) once for every pair of blocks (``one``, ``other``) their
    ``block`` is in; ``bucket`` names the pair. Pairs of blocks are as many as comparing all takes."""
    sizes = nodes.groupBy("group").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    placed = nodes.join(sizes, "group").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    paired = placed.withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    paired = paired.withColumns({"one": F.least("block", "with"), "other": F.greatest("block", "with")})
    return paired.withColumn("bucket", F.xxhash64("group", "one", "other")).drop("with", "blocks", "group")


def connected(members: DataFrame, group: str) -> DataFrame:
    """``node, root`` of nodes that groups connect, without the roots themselves."""
    members = members.select(group, "node")
    least = members.groupBy(group).agg(F.min("node").alias("b"))
    return components(members.join(least, group).select(F.col("node").alias("a"), "b"))


def fewest(near: DataFrame) -> DataFrame:
    """``bucket, node`` such that all nodes of a bucket of ``near`` meet. Nodes that buckets connect are one group,
    compared block with block, unless that takes more rows than the buckets have."""
    named = near.join(connected(near, "bucket"), "node", "left").withColumn("group", F.coalesce("root", "node"))
    size = F.count_distinct("node")
    costs = named.groupBy("group").agg((size * F.ceil(size / BLOCK) <= F.count("*")).alias("whole"))
    named = materialize(named.join(costs, "group").select("bucket", "node", "group", "whole"))
    whole_groups = block_pairs(named.where("whole").select("node", "group").distinct())
    return whole_groups.select("bucket", "node").unionByName(named.where("not whole").select("bucket", "node"))


def together(rows: DataFrame) -> DataFrame:
    """Rows of a bucket beside each other."""
    return rows.repartition("bucket").sortWithinPartitions("bucket")


def join(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, class_id, n_links`` and ``key`` (hash of the text).

    ``class_id`` is the least id of the documents connected by links (of Jaccard similarity 0.8 or more
    over the sets of 5-word shingles), ``n_links`` the number of other rows the row itself links, copies
    included. Null and empty texts and texts without words link nothing and are classes of their own.
    Rows of a repeated id are rows of their own; rows without an id get the least id of the others, null
    if there is none. Words are what stands between white space, as it is written. Other columns are
    ignored; an empty table gives an empty result."""
    return classed(docs).drop("class")


def classed(docs: DataFrame) -> DataFrame:
    """The rows of ``join`` plus ``class``, which tells classes apart; null for texts that link nothing."""
    joined = Join(docs)
    joined.run()
    classes = materialize(joined.classes())
    ids = classes.groupBy("class").agg(F.min("least_id").alias("class_id"))
    found = (
        joined.nodes.select("node", "name").join(classes.select("node", "class", "copies"), "node")
        .join(ids, "class").join(joined.links(classes), "node", "left")
        .select("name", "class", "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    )
    return joined.rows.select("doc_id", "key", F.when(F.col("n") > 0, F.col("name")).alias("name")).join(
        found, "name", "left"
    ).select(
        "doc_id", F.coalesce("class_id", F.when(F.col("name").isNull(), F.col("doc_id"))).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "key", "class",
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each class, its columns as they are: that of the least id (none comes last),
    then of the least text hash, then any one of those that repeat both.

    Null and empty texts and texts without words are classes of their own and stay."""
    rows = classed(docs).where("class is not null")
    named = materialize(rows.groupBy("class", "doc_id", "key").agg(F.count("*").alias("copies")))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    crowded = named.groupBy("class").agg(F.min(order).alias("first"), F.sum("copies").alias("n")).where("n > 1")
    stays = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("key") == F.col("first.key"))
    marked = materialize(
        named.join(crowded, "class").withColumn("_stays", stays).where("not _stays or copies > 1")
        .select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"), "_stays")
    )
    repeated = marked.where("_stays")
    few = marked.count() <= BROADCAST_NODES

    def joined(part: DataFrame, kind: str) -> DataFrame:
        held = F.broadcast(part) if few else part
        same = docs["doc_id"].eqNullSafe(held["_id"]) & (F.xxhash64(whole(docs["text"])) == held["_key"])
        return docs.join(held, same, kind)

    single = joined(marked, "left_anti")
    if repeated.isEmpty():
        return single
    packed = joined(repeated, "left_semi").select(F.struct("*").alias("row"))
    one = packed.groupBy(F.col("row.doc_id").alias("_id"), F.xxhash64(whole("row.text")).alias("_key")).agg(F.first("row").alias("row"))
    return single.unionByName(one.select("row.*"))
