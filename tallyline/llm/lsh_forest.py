"""Near copies by a forest of sorted minimum-hash signatures.

Texts (A-Z lower-cased) are sets of 5-word shingles; equal sets are one node with a sketch of minimum
hashes. Each tree of the forest is an order of the sketch's places. Nodes whose signatures agree in the
first ``DEPTH`` places of a tree lie in one region of it:

* in regions of at most ``REGION`` nodes all are candidates of each other,
* larger ones are sorted by the whole signature. Depth adapts to the region: a node's candidates are those
  with the shortest common prefix that leaves at most ``REGION`` of them, and in any case the ``NEXT``
  neighbours in order, which have the longest common prefixes.

Candidates whose sketches agree in ``AGREEING`` places or more connect clusters. A pair at the threshold
misses that with a chance of one in a million, so every component of links lies within a cluster. The links
in a cluster are then confirmed on the whole sets: all pairs at once in clusters of at most ``BLOCK``
nodes; larger ones are cut into blocks along several orders first, and where a cluster still falls into
parts, all nodes outside its greatest part are compared with all of the cluster, block with block. What the
forest proposes is thus decided exactly. That last step grows with the product of a cluster's nodes and
of those outside its greatest part.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.functions.skew import lookup_join
from tallyline.llm.common import stored, whole
from tallyline.llm.components import components, forest

WIDTH = 5  # words of a shingle
PERCENT = 85  # least similarity of a link
PLACES = 128  # of a sketch; a byte of each is kept
TREES = 16
DEPTH = 3  # places of a region's prefix; those of the trees are all different ones
LABEL = 20  # further places by which large regions are sorted
REGION = 256
NEXT = 32
AGREEING = 86
BLOCK = 256  # nodes whose sets are compared at once
ORDERS = 3  # along which large clusters are cut
BROADCAST_NODES = 1_000_000  # wanted nodes (about 40 bytes each) up to which they are sent to every task
KNOWN_WORDS = 100_000  # codes a task remembers
CHUNK = 4096  # sorted rows looked at together
MIX = np.uint64(0x9E3779B97F4A7C15)
MIX2 = np.uint64(0xBF58476D1CE4E5B9)
MIX3 = np.uint64(0x94D049BB133111EB)
Batches = Iterator[pa.RecordBatch]


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit mix of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * MIX2
    x = (x ^ (x >> np.uint64(27))) * MIX3
    return x ^ (x >> np.uint64(31))


# --- sets and signatures ---------------------------------------------------------------------


class Codes(dict):
    """Word -> 64-bit code, remembered for a bounded number of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def shingle_sets(texts: list[str], codes: Codes) -> list[np.ndarray]:
    """The sorted shingle codes of each text. Lower case and white space as bytes have them: ASCII only."""
    words = [text.encode().lower().split() for text in texts]
    counts = np.array(list(map(len, words)), dtype=np.int64)
    flat = np.fromiter(map(codes.__getitem__, itertools.chain.from_iterable(words)), np.uint64, count=int(counts.sum()))
    found = np.zeros(max(len(flat) - WIDTH + 1, 0), dtype=np.uint64)
    for k in range(WIDTH):
        found = mixed(found * MIX + flat[k : k + len(found)] + np.uint64(k + 1))
    sets, at = [], 0
    for n in counts.tolist():
        if n >= WIDTH:
            sets.append(np.unique(found[at : at + n - WIDTH + 1]))
        elif n:  # the whole sequence is the one shingle
            sets.append(np.array([xxhash.xxh64_intdigest(flat[at : at + n].tobytes(), n)], dtype=np.uint64))
        else:
            sets.append(np.zeros(0, dtype=np.uint64))
        at += n
    return sets


def factors() -> np.ndarray:
    return (mixed(np.arange(1, PLACES + 1, dtype=np.uint64) * MIX) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def minima(codes: np.ndarray, own: np.ndarray) -> np.ndarray:
    """The least product of the set's codes (their upper halves) with each odd factor, modulo 2^32."""
    upper = (codes >> np.uint64(32)).astype(np.uint32)
    low = np.full(len(own), np.iinfo(np.uint32).max, dtype=np.uint32)
    for at in range(0, len(upper), 512):
        low = np.minimum(low, (own[:, None] * upper[None, at : at + 512]).min(axis=1))
    return low


def prefixes(low: np.ndarray) -> np.ndarray:
    """The name of the region a node lies in, in each tree."""
    found = np.arange(1, TREES + 1, dtype=np.uint64) * MIX
    for place in low[: TREES * DEPTH].reshape(TREES, DEPTH).T:
        found = mixed(found * MIX2 + place.astype(np.uint64) + np.uint64(1))
    return found.view(np.int64)


def order_of(tree: int) -> np.ndarray:
    """The places by which a tree goes on after the prefix."""
    draw = mixed(np.arange(PLACES, dtype=np.uint64) * MIX + np.uint64(tree + 1))
    used = np.arange(tree * DEPTH, (tree + 1) * DEPTH)
    return np.array([p for p in np.argsort(draw, kind="stable") if p not in used][:LABEL])


def _signer() -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        codes, own = Codes(), factors()
        for batch in batches:
            for at in range(0, batch.num_rows, 100):
                part = batch.slice(at, 100)
                sets = shingle_sets(part.column(3).to_pylist(), codes)
                low = [minima(found, own) for found in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(i) for i in range(3)),
                        pa.array([hashlib.blake2b(found.tobytes(), digest_size=16).digest() for found in sets], pa.binary()),
                        pa.array([len(found) for found in sets], pa.int64()),
                        pa.array([values.astype(np.uint8).tobytes() for values in low], pa.binary()),
                        pa.array([prefixes(values).tolist() for values in low], pa.list_(pa.int64())),
                    ],
                    names=["row", "doc_id", "key", "name", "n", "sketch", "regions"],
                )

    return run


# --- candidates ------------------------------------------------------------------------------


def edges_of(nodes: np.ndarray, one: np.ndarray, other: np.ndarray) -> pa.RecordBatch:
    """Edges from each connected node to the least one it is connected with."""
    root = forest(len(nodes), one, other)
    least = nodes.copy()
    np.minimum.at(least, root, nodes)
    to = least[root]
    moved = np.flatnonzero(to != nodes)
    return pa.RecordBatch.from_arrays([pa.array(nodes[moved]), pa.array(to[moved])], names=["a", "b"])


def partner_ends(region: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Rows are sorted by region and label: up to where the rows after each one are its candidates."""
    n = len(region)
    common = np.zeros(n, dtype=np.int64)  # places shared with the row before, -1 in another region
    if n > 1:
        same = np.minimum.accumulate(labels[1:] == labels[:-1], axis=1)
        common[1:] = np.where(region[1:] == region[:-1], same.sum(axis=1), -1)
    common[0] = -1
    ends, open_ones = np.zeros(n, dtype=np.int64), np.ones(n, dtype=bool)
    for depth in range(labels.shape[1] + 1):
        starts = np.flatnonzero(common < depth)
        sizes = np.diff(np.append(starts, n))
        own = np.cumsum(common < depth) - 1
        end = (starts + sizes)[own]
        if depth == 0:
            ends = np.minimum(np.arange(n) + 1 + NEXT, end)
        fits = open_ones & (sizes[own] <= REGION)
        ends[fits] = np.maximum(ends[fits], end[fits])
        open_ones &= ~fits
        if not open_ones.any():
            break
    return ends


def agreeing(sketches: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a row and one of its candidates whose sketches agree in enough places."""
    counts = ends - np.arange(len(ends)) - 1
    done = np.cumsum(counts)
    found, at = [], 0
    while at < len(ends):
        to = max(int(np.searchsorted(done, (done[at - 1] if at else 0) + (1 << 15), side="right")), at + 1)
        size = counts[at:to]
        one = np.repeat(np.arange(at, to), size)
        other = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + one + 1
        like = (sketches[one] == sketches[other]).sum(axis=1) >= AGREEING
        found.append((one[like], other[like]))
        at = to
    return tuple(map(np.concatenate, zip(*found)))


def _labels(batches: Batches) -> Batches:
    """Adds the signature that sorts a region: (region, tree, node, sketch) -> + label."""
    orders = np.stack([order_of(tree) for tree in range(TREES)])
    for batch in batches:
        sketches = np.frombuffer(b"".join(batch.column(3).to_pylist()), dtype=np.uint8).reshape(-1, PLACES)
        tree = np.array(batch.column(1))
        labels = np.take_along_axis(sketches, orders[tree], axis=1)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), batch.column(3), pa.array([row.tobytes() for row in labels], pa.binary())],
            names=["region", "node", "sketch", "label"],
        )


def _compare(batches: Batches) -> Batches:
    """Edges between like nodes; rows come sorted by region and label. Some rows are carried over, so that
    a chunk's end parts no near neighbours; a region that is small is never parted."""

    def compared(region, node, sketch, label) -> pa.RecordBatch:
        ends = partner_ends(region, label)
        return edges_of(node, *agreeing(sketch, ends))

    held = None
    for batch in batches:
        for start in range(0, batch.num_rows, CHUNK):
            part = batch.slice(start, CHUNK)
            fresh = [
                np.array(part.column(0)), np.array(part.column(1)),
                *(np.frombuffer(b"".join(part.column(k).to_pylist()), np.uint8).reshape(part.num_rows, -1) for k in (2, 3)),
            ]
            held = fresh if held is None else [np.concatenate(pair) for pair in zip(held, fresh)]
            if len(held[0]) > CHUNK:
                yield compared(*held)
                held = [values[-REGION:] for values in held]
    if held is not None and len(held[0]):
        yield compared(*held)


# --- confirmation ----------------------------------------------------------------------------


def linked(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of sets with a similarity of at least ``PERCENT``, exactly: shared codes are counted by
    products of blocks of the incidence matrix."""
    m = len(sets)
    sizes = np.array(list(map(len, sets)))
    both = np.zeros((m, m))
    if m == 2:
        both[0, 1] = len(np.intersect1d(*sets, assume_unique=True))
    else:
        owner = np.repeat(np.arange(m), sizes)
        _, where, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        shared = times[where] > 1
        owner, column = owner[shared], where[shared]
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], np.cumsum(np.diff(column[order], prepend=-1) != 0) - 1
        width = 1 << 13
        for at in range(0, int(column[-1]) + 1 if len(column) else 0, width):
            a, b = np.searchsorted(column, [at, at + width])
            held = np.zeros((m, min(width, int(column[-1]) + 1 - at)), dtype=np.float32)
            held[owner[a:b], column[a:b] - at] = 1
            both += held @ held.T
    # 100 I >= p (a + b - I)
    match = (100 + PERCENT) * both >= PERCENT * (sizes[:, None] + sizes[None, :])
    return np.nonzero(np.triu(match, 1))


def _confirm(batches: Batches) -> Batches:
    """Edges of each bucket (bucket, node, text), whose rows lie beside each other."""
    codes = Codes()
    parts = (batch.slice(at, 100) for batch in batches for at in range(0, batch.num_rows, 100))
    rows = (row for part in parts for row in zip(*(column.to_pylist() for column in part.columns)))
    for _, found in itertools.groupby(rows, key=lambda row: row[0]):
        texts = {node: text for _, node, text in found}
        if len(texts) > 1:
            nodes = np.array(sorted(texts))
            yield edges_of(nodes, *linked(shingle_sets([texts[node] for node in nodes.tolist()], codes)))


def _blocks(order: int) -> Callable[[Batches], Batches]:
    """(root, node, label), sorted by root and label -> block, node: neighbours in order share a block."""

    def run(batches: Batches) -> Batches:
        root, number, held = None, 0, 0
        for batch in batches:
            names = []
            for own, node in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if own != root or held == BLOCK:
                    root, number, held = own, node, 0  # a block is named by its first node
                held += 1
                names.append(number)
            named = mixed(np.array(names, dtype=np.uint64) * MIX + np.uint64(order + 1)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(named), batch.column(1)], names=["bucket", "node"])

    return run


# --- plan ------------------------------------------------------------------------------------


class Forest:
    """The near copies of one corpus."""

    def __init__(self, docs: DataFrame):
        self.docs = docs.select("doc_id", whole("text").alias("text"), F.xxhash64(whole("text")).alias("key"))
        kind = docs.schema["doc_id"].dataType.simpleString()
        # Rows get a number when their signatures are stored; it tells rows of equal or no id apart.
        self.rows = stored(
            self.docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "key", "text").mapInArrow(
                _signer(),
                f"row long, doc_id {kind}, key long, name binary, n long, sketch binary, regions array<long>",
            )
        )
        own = F.min(F.struct("row", "doc_id", "key")).alias("first")
        self.nodes = stored(
            self.rows.where("n > 0").groupBy("name")
            .agg(own, F.min("doc_id").alias("least_id"), F.first("sketch").alias("sketch"), F.first("regions").alias("regions"))
            .select(F.col("first.row").alias("node"), "first.doc_id", "first.key", "name", "least_id", "sketch", "regions")
        )

    def clusters(self) -> DataFrame:
        """``node, root, size`` of the nodes that candidates connect with others."""
        placed = self.nodes.select("node", F.posexplode("regions").alias("tree", "region"))
        crowded = placed.groupBy("region").agg(F.count("*").alias("size")).where("size > 1")
        members = stored(lookup_join(placed, crowded, ["region"], "inner"))
        signed = members.join(self.nodes.select("node", "sketch"), "node").select("region", "tree", "node", "sketch", "size")
        columns = "region long, node long, sketch binary, label binary"
        small = signed.where(F.col("size") <= REGION).select("region", "tree", "node", "sketch")
        met = [small.mapInArrow(_labels, columns).repartition("region").sortWithinPartitions("region")]
        large = members.where(F.col("size") > REGION)
        if not large.isEmpty():
            rows = signed.where(F.col("size") > REGION).select("region", "tree", "node", "sketch")
            rows = stored(rows.mapInArrow(_labels, columns))
            met.append(rows.repartitionByRange("region", "label").sortWithinPartitions("region", "label"))
        edges = [stored(rows.mapInArrow(_compare, "a long, b long").distinct()) for rows in met]
        roots = components(reduce(DataFrame.unionByName, edges))
        heads = roots.select(F.col("root").alias("node"), "root").distinct()
        every = roots.unionByName(heads)
        sizes = roots.groupBy("root").agg((F.count("*") + 1).alias("size"))
        return stored(lookup_join(every, sizes, ["root"], "inner").select("node", "root", "size"))

    def confirmed(self, placed: DataFrame) -> DataFrame:
        """Edges between the nodes of each bucket (``bucket, node``)."""
        wanted = stored(
            placed.select("node").distinct().join(self.nodes.select("node", "doc_id", "key"), "node")
            .select("node", F.col("doc_id").alias("_id"), F.col("key").alias("_key"))
        )
        keys = F.broadcast(wanted) if wanted.count() <= BROADCAST_NODES else wanted
        same = (F.col("key") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_id"))
        texts = self.docs.join(keys, same).select("node", "text")
        rows = placed.join(texts, "node").select("bucket", "node", "text")
        return stored(rows.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_confirm, "a long, b long"))

    def links(self) -> DataFrame:
        """Edges whose components are those of all links."""
        clusters = self.clusters()
        small = clusters.where(F.col("size") <= BLOCK).select(F.col("root").alias("bucket"), "node")
        edges = self.confirmed(small)
        large = clusters.where(F.col("size") > BLOCK)
        if large.isEmpty():
            return edges
        sketched = stored(large.join(self.nodes.select("node", "sketch"), "node").select("root", "node", "sketch"))
        buckets = []
        for order in range(ORDERS):
            places = order_of(TREES + order) + 1
            label = F.concat(*[F.substring("sketch", int(place), 1) for place in places])
            by = sketched.select("root", "node", label.alias("label"))
            by = by.repartitionByRange("root", "label").sortWithinPartitions("root", "label")
            buckets.append(stored(by.mapInArrow(_blocks(order), "bucket long, node long")))
        found = self.confirmed(reduce(DataFrame.unionByName, buckets))
        rest = self.undecided(large, components(found))
        if not rest.isEmpty():
            found = found.unionByName(self.confirmed(rest))
        return edges.unionByName(found)

    def undecided(self, large: DataFrame, roots: DataFrame) -> DataFrame:
        """``bucket, node``: blocks of the nodes outside the greatest part of a cluster, each with every block of
        the cluster."""
        parted = stored(
            large.select("node", F.col("root").alias("cluster"))
            .join(roots, "node", "left").select("cluster", "node", F.coalesce("root", "node").alias("part"))
        )
        sizes = parted.groupBy("cluster", "part").agg(F.count("*").alias("n"))
        greatest = sizes.groupBy("cluster").agg(
            F.max_by("part", F.struct("n", "part")).alias("greatest"), F.sum("n").alias("all"), F.max("n").alias("most")
        ).where(F.col("all") > F.col("most"))
        named = lookup_join(parted, greatest, ["cluster"], "inner").withColumns(
            {
                "outer_blocks": F.ceil((F.col("all") - F.col("most")) * 2 / BLOCK),
                "blocks": F.ceil(F.col("all") * 2 / BLOCK),
            }
        )
        place = F.xxhash64("node")
        inner = named.withColumn("j", F.pmod(place, F.col("blocks"))).withColumn(
            "i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("outer_blocks") - 1))
        )
        outer = named.where(F.col("part") != F.col("greatest")).withColumn("i", F.pmod(place, F.col("outer_blocks"))).withColumn(
            "j", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
        )
        both = inner.select("cluster", "i", "j", "node").unionByName(outer.select("cluster", "i", "j", "node"))
        return stored(both.select(F.xxhash64("cluster", "i", "j").alias("bucket"), "node"))


def near_copies(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (``doc_id, text``): ``doc_id, n_shingles, component_id, kept``.

    ``component_id`` is the least id of the documents that links connect (similarity of the shingle sets of
    ``PERCENT`` percent or more), ``kept`` whether it is the row's own. Null and empty texts and texts
    without words have no shingles and are on their own. Rows of a repeated id are rows of their own;
    rows without an id get the least id of the others, null if there is none, and are not kept. Other columns
    are ignored; an empty table gives an empty result. Texts are compared whole, however long."""
    found = Forest(docs)
    roots = components(found.links())
    nodes = found.nodes.select("node", "name", "least_id").join(roots, "node", "left")
    nodes = stored(nodes.select("name", F.coalesce("root", "node").alias("part"), "least_id"))
    least = nodes.groupBy("part").agg(F.min("least_id").alias("component_id"))
    named = lookup_join(nodes, least, ["part"]).select("name", "component_id")
    rows = found.rows.select("doc_id", F.when(F.col("n") > 0, F.col("name")).alias("name"), F.col("n").alias("n_shingles"))
    own = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return lookup_join(rows, named, ["name"]).select(
        "doc_id", "n_shingles", own.alias("component_id"), F.coalesce(F.col("doc_id") == own, F.lit(False)).alias("kept")
    )
