"""Alignment of two tokenizers' tokens over the bytes of each text.

Tokenizer A (byte-level BPE) reads a blank and the text, tokenizer B (pieces) the text, to which it adds the
blank itself. Both cut the same bytes, so their tokens are two token-byte incidence matrices in CSR
form: a row per token, a column per byte. The row product A x B^T (Gustavson: each row of A adds up the
rows of B^T that its columns name) holds the bytes that a token of A and one of B share, that is, their
overlap links. Offsets where tokens of both end cut the bytes into groups; the product of the two
token-group incidences holds the pairs of tokens of one group.

How often an id pair is linked is counted over the corpus: the distinct pairs of each document are stored
packed, counted in every task, and the sums go back to the documents in slices of a bounded size.

Null and empty texts have no tokens, nor have texts whose joined token bytes differ from the blank and
the text. A text is cut whole, however long; several short ones are cut together. Repeated rows are
documents of their own, other columns are ignored, and an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import stored, whole

TOGETHER = 1_000_000  # characters of texts that are cut together
PAIR_BITS = 40
PARTIALS = 1 << 21  # partial products of a block of rows
COUNTED = 1 << 22  # pairs a task gathers before it counts them
PAIRS = 2_000_000  # id pairs (17 bytes each) that are sent to every task at once
# Characters whose class may differ from one Unicode version to another (beyond the Latin blocks), long runs.
UNUSUAL = re.compile("[^\\x00-\u024f]|\\S{1000}|\\s{1000}")

# --- matrices --------------------------------------------------------------------------------


@dataclass
class Csr:
    """A sparse matrix: row ``i`` has ``columns[starts[i]:starts[i + 1]]`` with their ``values``."""

    starts: np.ndarray
    columns: np.ndarray
    values: np.ndarray
    width: int

    def transposed(self) -> Csr:
        starts = np.zeros(self.width + 1, dtype=np.int64)
        np.cumsum(np.bincount(self.columns, minlength=self.width), out=starts[1:])
        rows = np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))
        if len(self.columns) and (np.diff(self.columns) < 0).any():
            order = np.argsort(self.columns, kind="stable")
            return Csr(starts, rows[order], self.values[order], len(self.starts) - 1)
        return Csr(starts, rows, self.values, len(self.starts) - 1)


def intervals(lengths: np.ndarray) -> Csr:
    """Incidence of consecutive tokens of these lengths and the bytes."""
    starts = np.concatenate([[0], np.cumsum(lengths)])
    return Csr(starts, np.arange(starts[-1]), np.ones(starts[-1], dtype=np.int32), int(starts[-1]))


def membership(group: np.ndarray, groups: int) -> Csr:
    """Incidence of tokens and their group, one each."""
    return Csr(np.arange(len(group) + 1), group, np.ones(len(group), dtype=np.int32), groups)


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``starts[i] .. starts[i] + sizes[i] - 1``, one after another."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def product(a: Csr, b: Csr) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Row, column and value of the entries of ``a x b``, in blocks of consecutive rows."""
    sizes = b.starts[a.columns + 1] - b.starts[a.columns]
    done = np.concatenate([[0], np.cumsum(sizes)])[a.starts]  # partial products before each row
    at, rows = 0, len(a.starts) - 1
    while at < rows:
        to = max(int(np.searchsorted(done, done[at] + PARTIALS, side="right")) - 1, at + 1)
        lo, hi = a.starts[at], a.starts[to]
        size = sizes[lo:hi]
        where = ranges(b.starts[a.columns[lo:hi]], size)
        owner = np.repeat(np.arange(at, to), np.diff(a.starts[at : to + 1]))
        row, column = np.repeat(owner, size), b.columns[where]
        value = np.repeat(a.values[lo:hi], size) * b.values[where]
        key = row * b.width + column
        if (np.diff(key) < 0).any():
            order = np.argsort(key, kind="stable")
            row, column, value, key = row[order], column[order], value[order], key[order]
        if len(key):
            first = np.flatnonzero(np.diff(key, prepend=-1))
            yield row[first], column[first], np.add.reduceat(value, first)
        at = to


# --- tokenizers ------------------------------------------------------------------------------


def byte_of_character() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones are themselves, the
    others follow from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [byte for byte in range(256) if byte not in shown]
    return {chr(byte): byte for byte in shown} | {chr(256 + k): byte for k, byte in enumerate(hidden)}


class ByteTokenizer:
    """Byte-level BPE of a tokenizer file, without special tokens.

    Where ids are the ranks of the merges, Latin texts without very long runs are cut by a second library
    that is several times as fast and gives the same ids there; all others by the file's own."""

    def __init__(self, blob: bytes):
        from tokenizers import Tokenizer

        self.own = Tokenizer.from_str(blob.decode())
        self.own.encode_special_tokens = True
        described = json.loads(blob)
        of = byte_of_character()
        special = {token["id"] for token in described["added_tokens"]}
        vocabulary = described["model"]["vocab"]
        self.bytes = [b""] * (max([*vocabulary.values(), *special]) + 1)
        for token, number in vocabulary.items():
            if number not in special:
                self.bytes[number] = bytes(of[c] for c in token)
        self.fast = None
        merges = [m if isinstance(m, str) else " ".join(m) for m in described["model"]["merges"]]
        if [vocabulary[m.replace(" ", "")] for m in merges] == list(range(256, 256 + len(merges))):
            import public_tokenizers
            import tiktoken

            ranks = {token: number for number, token in enumerate(self.bytes) if token}
            self.fast = tiktoken.Encoding(
                "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
            )

    def encode(self, texts: list[str]) -> list[list[int]]:
        found: list = [None] * len(texts)
        for i, text in enumerate(texts):
            if self.fast and not UNUSUAL.search(text):
                found[i] = self.fast.encode_ordinary(text)
        rest = [i for i, ids in enumerate(found) if ids is None]
        for i in rest:
            found[i] = self.own.encode(texts[i], add_special_tokens=False).ids
        return found


class PieceTokenizer:
    """Pieces of a sentencepiece model, without special tokens."""

    def __init__(self, blob: bytes):
        import sentencepiece

        self.own = sentencepiece.SentencePieceProcessor(model_proto=blob)
        self.bytes = []
        for number in range(self.own.get_piece_size()):
            piece = self.own.id_to_piece(number)
            self.bytes.append(
                bytes([int(piece[3:5], 16)]) if self.own.is_byte(number) else piece.replace("▁", " ").encode()
            )

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.own.encode(texts, num_threads=1)


# --- alignment in a task ---------------------------------------------------------------------


class Aligned:
    """The alignment of some texts cut together: their tokens lie one after another, groups and bytes are
    numbered through."""

    def __init__(self, texts: list[str], a: ByteTokenizer, b: PieceTokenizer):
        self.texts, self.ids = len(texts), max(len(a.bytes), len(b.bytes))
        filled = [(i, text) for i, text in enumerate(texts) if text]
        cut = zip(filled, a.encode([" " + text for _, text in filled]), b.encode([text for _, text in filled]))
        ids: tuple[list, list] = ([], [])
        counts = np.zeros((2, len(texts)), dtype=np.int64)
        for (i, text), one, other in cut:
            wanted = b" " + text.encode()
            if wanted == b"".join(map(a.bytes.__getitem__, one)) == b"".join(map(b.bytes.__getitem__, other)):
                for side, found in enumerate((one, other)):
                    ids[side].append(np.array(found, dtype=np.int64))
                    counts[side, i] = len(found)
        self.n_a, self.n_b = counts
        self.a, self.b = (np.concatenate([np.zeros(0, dtype=np.int64), *found]) for found in ids)
        sizes = (np.array([len(token) for token in t.bytes], dtype=np.int64) for t in (a, b))
        self.incidence = [intervals(size[own]) for size, own in zip(sizes, (self.a, self.b))]
        ends = [matrix.starts[1:] for matrix in self.incidence]
        self.cuts = np.intersect1d(*ends, assume_unique=True)
        self.group_a, self.group_b = (np.searchsorted(self.cuts, end) for end in ends)
        self.text_a, self.text_b = (np.repeat(np.arange(len(texts)), n) for n in (self.n_a, self.n_b))
        # the group a text starts with; those without tokens have none
        last = np.zeros(len(texts), dtype=np.int64)
        last[self.text_a] = self.group_a + 1
        last = np.maximum.accumulate(last) if len(last) else last
        self.n_groups = np.diff(last, prepend=0)
        self.first_group = last - self.n_groups

    def overlaps(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Tokens of A and B that share bytes, and how many."""
        blocks = list(product(self.incidence[0], self.incidence[1].transposed()))
        if not blocks:
            return tuple(np.zeros(0, dtype=np.int64) for _ in range(3))
        return tuple(map(np.concatenate, zip(*blocks)))

    def shared_groups(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Tokens of A and B in the same group, in blocks: long groups have many."""
        groups = len(self.cuts)
        for row, column, _ in product(membership(self.group_a, groups), membership(self.group_b, groups).transposed()):
            yield row, column

    def described(self, written: np.ndarray) -> list[str]:
        """The groups of each text as ``a1,a2|b1;a3|b2,b3``; ``written`` holds the ids with each mark behind."""
        side = np.repeat([0, 1], [len(self.a), len(self.b)])
        group = np.concatenate([self.group_a, self.group_b])
        order = np.argsort(group * 2 + side, kind="stable")
        ids = np.concatenate([self.a, self.b])[order]
        group, side = group[order], side[order]
        mark = np.where(np.diff(group, append=-1) != 0, 2, np.diff(side, append=0) != 0)
        parts = written[mark, ids].tolist()
        ends = np.cumsum(self.n_a + self.n_b).tolist()
        return ["".join(parts[start:end])[:-1] for start, end in zip([0, *ends], ends)]


Batches = Iterator[pa.RecordBatch]


def _aligned(batches: Batches, blobs) -> Iterator[tuple[pa.RecordBatch, Aligned]]:
    """Rows (row, doc_id, text) in parts of about ``TOGETHER`` characters, with their alignment."""
    a, b = ByteTokenizer(blobs.value[0]), PieceTokenizer(blobs.value[1])
    for batch in batches:
        start, held = 0, 0
        texts = batch.column(2)
        for at in range(batch.num_rows):
            held += len(texts[at].as_py())
            if held >= TOGETHER or at + 1 == batch.num_rows:
                part = batch.slice(start, at + 1 - start)
                yield part, Aligned(part.column(2).to_pylist(), a, b)
                start, held = at + 1, 0


def split(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """One list per text of values that lie one after another."""
    ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.astype(np.int32)))


def _tokens(blobs) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for part, found in _aligned(batches, blobs):
            one, other, shared = found.overlaps()
            links = np.bincount(found.text_a[one], minlength=found.texts)
            before_a, before_b = (np.cumsum(n) - n for n in (found.n_a, found.n_b))
            text = found.text_a[one]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0), part.column(1), split(found.a, found.n_a), split(found.b, found.n_b),
                    split(found.group_a - found.first_group[found.text_a], found.n_a),
                    split(found.group_b - found.first_group[found.text_b], found.n_b),
                    split(one - before_a[text], links), split(other - before_b[text], links), split(shared, links),
                ],
                names=["row", "doc_id", "a_ids", "b_ids", "a_groups", "b_groups", "link_a", "link_b", "link_bytes"],
            )

    return run


def _group_links(blobs) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for part, found in _aligned(batches, blobs):
            before_a, before_b = (np.cumsum(n) - n for n in (found.n_a, found.n_b))
            rows = np.array(part.column(0))
            for one, other in found.shared_groups():
                text = found.text_a[one]
                for at in range(0, len(one), 50_000):
                    cut = slice(at, at + 50_000)
                    ids = part.column(1).take(pa.array(text[cut]))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(rows[text[cut]]), ids,
                            pa.array((one - before_a[text])[cut].astype(np.int32)),
                            pa.array((other - before_b[text])[cut].astype(np.int32)),
                            pa.array((found.group_a[one] - found.first_group[text])[cut].astype(np.int32)),
                        ],
                        names=["row", "doc_id", "a_at", "b_at", "group"],
                    )

    return run


def _packed(blobs, pieces: int) -> Callable[[Batches], Batches]:
    """Counts and digest of each text, and its distinct linked id pairs (``a * pieces + b``) with the
    number of links each has."""

    def run(batches: Batches) -> Batches:
        written = None
        for part, found in _aligned(batches, blobs):
            if written is None:
                written = np.array([[f"{i}{mark}" for i in range(found.ids)] for mark in ",|;"], dtype=object)
            one, other, _ = found.overlaps()
            # texts of a part and id pairs share 63 bits: vocabularies are below a million, texts below TOGETHER
            both = np.sort((found.text_a[one] << PAIR_BITS) | (found.a[one] * pieces + found.b[other]))
            text, pair = both >> PAIR_BITS, both & ((1 << PAIR_BITS) - 1)
            first = np.flatnonzero(np.diff(both, prepend=-1))
            times = np.diff(np.append(first, len(pair))).astype("<u4")
            ends = np.searchsorted(text[first], np.arange(found.texts + 1)).tolist()
            pairs = pair[first].astype("<u8" if len(pair) and pair.max() >> 32 else "<u4")
            digests = [hashlib.sha256(s.encode()).hexdigest() if s else "" for s in found.described(written)]
            cuts = list(zip(ends, ends[1:]))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0), part.column(1), pa.array(found.n_a), pa.array(found.n_b), pa.array(found.n_groups),
                    pa.array(np.bincount(text, minlength=found.texts).astype(np.int64)), pa.array(digests, pa.string()),
                    pa.array([pairs[lo:hi].tobytes() for lo, hi in cuts], pa.binary()),
                    pa.array([times[lo:hi].tobytes() for lo, hi in cuts], pa.binary()),
                ],
                names=["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"],
            )

    return run


def numbers(blob: bytes, count: int) -> np.ndarray:
    """Packed integers; their width follows from their number."""
    return np.frombuffer(blob, dtype="<u8" if len(blob) == 8 * count else "<u4").astype(np.int64)


def _pair_counts(batches: Batches) -> Batches:
    """In how many of the task's documents each pair is linked."""

    def counted(held: list[np.ndarray]) -> pa.RecordBatch:
        pair, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n.astype(np.int64))], names=["pair", "n"])

    held, size = [], 0
    for batch in batches:
        for pairs, times in zip(batch.column(0), batch.column(1)):
            held.append(numbers(pairs.as_py(), len(times.as_py()) // 4))
            size += len(held[-1])
            if size >= COUNTED:
                yield counted(held)
                held, size = [], 0
    if held:
        yield counted(held)


def _scored(shared) -> Callable[[Batches], Batches]:
    """Adds to each text the links whose pair is the best of its A id, and the sum of the counts of its
    links, as far as their pairs are in this slice."""

    def run(batches: Batches) -> Batches:
        known, counts, best = shared.value
        for whole_batch in batches:
            for at in range(0, whole_batch.num_rows, 500):
                batch = whole_batch.slice(at, 500)
                times = [np.frombuffer(t.as_py(), dtype="<u4").astype(np.int64) for t in batch.column("times")]
                pairs = [numbers(p.as_py(), len(t)) for p, t in zip(batch.column("pairs"), times)]
                text = np.repeat(np.arange(batch.num_rows), list(map(len, times)))
                pair, time = np.concatenate(pairs), np.concatenate(times)
                where = np.searchsorted(known, pair)
                hit = where < len(known)
                hit[hit] = known[where[hit]] == pair[hit]
                text, time, where = text[hit], time[hit], where[hit]
                sums = np.zeros((2, batch.num_rows), dtype=np.int64)
                np.add.at(sums[0], text, time * best[where])
                np.add.at(sums[1], text, time * counts[where])
                kept = [batch.column(name) for name in KEPT]
                yield pa.RecordBatch.from_arrays([*kept, *map(pa.array, sums)], names=[*KEPT, "n_best", "count_sum"])

    return run


KEPT = ("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")

# --- plan ------------------------------------------------------------------------------------


def _texts(docs: DataFrame, byte_file: str, piece_file: str):
    """``row, doc_id, text``, the type of the id, and the two tokenizer files, which are sent to the tasks."""
    blobs = []
    for path in (byte_file, piece_file):
        with open(path, "rb") as file:  # a few MB each
            blobs.append(file.read())
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", whole("text").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows, kind, docs.sparkSession.sparkContext.broadcast(tuple(blobs))


def align(docs: DataFrame, byte_file: str, piece_file: str) -> DataFrame:
    """Per row of ``docs`` (``doc_id, text``) its tokens and their overlap links: ``a_ids, b_ids``, the
    group of each token (``a_groups, b_groups``) and per link the places of its tokens and the bytes they
    share (``link_a, link_b, link_bytes``). ``row`` tells rows of equal ids apart. See the module for odd
    texts, which have empty lists."""
    rows, kind, blobs = _texts(docs, byte_file, piece_file)
    lists = ", ".join(
        f"{name} array<int>" for name in ("a_ids", "b_ids", "a_groups", "b_groups", "link_a", "link_b", "link_bytes")
    )
    return rows.mapInArrow(_tokens(blobs), f"row long, doc_id {kind}, {lists}")


def group_links(docs: DataFrame, byte_file: str, piece_file: str) -> DataFrame:
    """``row, doc_id, a_at, b_at, group``: every pair of tokens of one group, one row each."""
    rows, kind, blobs = _texts(docs, byte_file, piece_file)
    return rows.mapInArrow(_group_links(blobs), f"row long, doc_id {kind}, a_at int, b_at int, group int")


def summarize(docs: DataFrame, byte_file: str, piece_file: str) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_a, n_b, n_groups, n_links``, ``n_best`` (links whose id pair is linked
    in as many documents of the corpus as any pair of its A id), ``count_sum`` (these numbers of documents,
    over all links) and ``groups_sha256`` (of the groups written out; empty without tokens)."""
    rows, kind, blobs = _texts(docs, byte_file, piece_file)
    pieces = len(PieceTokenizer(blobs.value[1]).bytes)
    own = f"row long, doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
    packed = stored(rows.mapInArrow(_packed(blobs, pieces), f"{own}, pairs binary, times binary"))
    counted = packed.select("pairs", "times").mapInArrow(_pair_counts, "pair long, n long")
    counts = counted.groupBy("pair").agg(F.sum("n").alias("n")).withColumn("a", F.expr(f"pair div {pieces}"))
    counts = stored(counts)
    top = counts.groupBy("a").agg(F.max("n").alias("most"))
    ranked = stored(counts.join(top, "a").select("pair", "n", "a", (F.col("n") == F.col("most")).alias("best")))
    parts = slices(ranked)
    scored = []
    for number in range(parts):
        known = ranked.where(F.pmod(F.xxhash64("a"), F.lit(parts)) == number).select("pair", "n", "best").toArrow()
        pair, n, best = (np.array(known.column(name)) for name in ("pair", "n", "best"))
        order = np.argsort(pair)
        shared = docs.sparkSession.sparkContext.broadcast((pair[order], n[order], best[order].astype(np.int64)))
        scored.append(packed.mapInArrow(_scored(shared), f"{own}, n_best long, count_sum long"))
        if parts > 1:
            scored[-1] = stored(scored[-1])
            shared.destroy()
    result = scored[0]
    if parts > 1:
        result = reduce(DataFrame.unionByName, scored).groupBy(*KEPT).agg(
            F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")
        )
    return result.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def slices(ranked: DataFrame) -> int:
    """Into how many slices by A id the pairs are cut, so that none has more than ``PAIRS``. An id has no
    more pairs than B has pieces."""
    parts = 1
    while True:
        by = F.pmod(F.xxhash64("a"), F.lit(parts)).alias("slice")
        largest = ranked.groupBy(by).count().agg(F.max("count")).first()[0] or 0
        if largest <= PAIRS:
            return parts
        parts = 2 * max(parts, -(-largest // PAIRS))
