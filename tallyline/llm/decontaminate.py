"""Benchmark decontamination by spaced seeds.

Words (letters and digits, lower case) of benchmark items and of documents are hashed under fixed masks
that skip some of the positions they span, so that a changed word leaves other seeds whole. Equal hashes
put an item beside a place of a document (their diagonal). Around the hits the words are compared one by
one: the longest stretch from one equal word to another with four matches or more to a substitution must
be long enough.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import whole
from tallyline.session import materialize

# Together they meet every stretch the rule reports: each way to change one word in 8 or 9, two in 10 to 14 and
# three in 15 or 16 leaves a place where one of them fits. Items of five to seven words are met when they are
# whole; shorter ones say too little.
MASKS = ("11111", "111011", "11010011")
BROADCAST_SEEDS = 2_000_000  # benchmark seeds (32 bytes each) up to which they are sent to every task
BROADCAST_HITS = 1_000_000  # documents with hits, likewise


@dataclass(frozen=True)
class Overlap:
    """Words a stretch must have: ``share`` of the item's, at least ``least`` and at most ``most``; and the
    price of a substitution in matches (4: stretches of 80 % matches or more). Items of fewer words than
    ``least`` must be there whole, without a substitution."""

    least: int = 8
    most: int = 13
    share: float = 0.6
    price: int = 4


def tokens_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+", -1), lambda w: w != "")


def seeds(tokens: Column) -> Column:
    """``struct(h, at)`` of every mask at every place; texts shorter than a mask have none of it."""
    hashed = []
    for number, mask in enumerate(MASKS):
        kept = [k for k, bit in enumerate(mask) if bit == "1"]

        def seed(at: Column, number=number, kept=kept) -> Column:
            return F.struct(F.xxhash64(F.lit(number), *[F.get(tokens, at + k) for k in kept]).alias("h"), at.alias("at"))

        places = F.sequence(F.lit(0), F.size(tokens) - len(mask))
        none = F.array().cast("array<struct<h:bigint,at:int>>")
        hashed.append(F.when(F.size(tokens) >= len(mask), F.transform(places, _one(seed))).otherwise(none))
    return F.concat(*hashed)


def _one(seed):
    return lambda at: seed(at)


def items_of(benchmark: DataFrame) -> DataFrame:
    """``item_id, item`` (words) and ``item_key``, which names an item by both. Rows that repeat an item
    count once."""
    items = benchmark.select("item_id", tokens_of(whole("text")).alias("item")).where(F.size("item") > 0).distinct()
    id_hash = F.xxhash64(F.col("item_id").isNull(), F.col("item_id"))
    return items.withColumn("item_key", F.xxhash64(id_hash, F.array_join("item", " ")))


def hits(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``doc_id, key, item_key, diagonal``: where seeds of an item and a document agree, once per
    diagonal. ``key`` is the hash of the text; with the id it names a row."""
    held = items.select("item_key", F.explode(seeds(F.col("item"))).alias("s")).select(
        "item_key", F.col("s.h").alias("h"), F.col("s.at").alias("item_at")
    )
    text = docs.select("doc_id", whole("text").alias("_text"))
    found = (
        text.select("doc_id", F.xxhash64("_text").alias("key"), tokens_of(F.col("_text")).alias("_tokens"))
        .select("doc_id", "key", F.explode(seeds(F.col("_tokens"))).alias("s"))
        .select("doc_id", "key", "s.h", "s.at")
    )
    if held.count() <= BROADCAST_SEEDS:
        held = F.broadcast(held)
    return (
        found.join(held, "h")
        .groupBy("doc_id", "key", "item_key", (F.col("at") - F.col("item_at")).alias("diagonal")).count()
        .drop("count")
    )


def longest_stretch(equal: Column, price: int) -> Column:
    """``struct(words, matched, start)`` of the longest stretch that begins and ends with an equal word and
    has at least ``price`` of them to each other word; no words where none is equal.

    The longest one begins and ends where runs of equal words do. Ordered by their height (matches -
    price * others before them), each end goes with the first of the starts that are no higher."""
    places = F.sequence(F.lit(0), F.size(equal) - 1)
    at = lambda k: F.coalesce(F.get(equal, k), F.lit(False))
    starts = F.filter(places, lambda k: at(k) & ~at(k - 1))
    ends = F.filter(places, lambda k: at(k) & ~at(k + 1))
    runs = F.arrays_zip(starts.alias("start"), ends.alias("end"))
    none = F.array().cast("array<struct<height:int,last:boolean,at:int>>")

    def edges(seen: Column, run: Column) -> Column:
        start, end = run["start"], run["end"] + 1
        before = (1 + price) * seen["matched"] - price * start
        first = F.struct(before.alias("height"), F.lit(False).alias("last"), start.alias("at"))
        last = F.struct((before + end - start).alias("height"), F.lit(True).alias("last"), end.alias("at"))
        return F.struct(
            (seen["matched"] + end - start).alias("matched"), F.concat(seen["edges"], F.array(first, last)).alias("edges")
        )

    found = F.aggregate(runs, F.struct(F.lit(0).alias("matched"), none.alias("edges")), edges)["edges"]
    best = F.struct(F.lit(0).alias("words"), F.lit(0).alias("matched"), F.lit(0).alias("start"))
    zero = F.struct(F.lit(2**31 - 1).alias("first"), F.lit(0).alias("height"), best.alias("best"))

    def step(seen: Column, edge: Column) -> Column:
        earlier = ~edge["last"] & (edge["at"] < seen["first"])
        words = edge["at"] - seen["first"]
        matched = ((edge["height"] - seen["height"] + price * words) / (1 + price)).cast("int")
        this = F.struct(words.alias("words"), matched.alias("matched"), seen["first"].alias("start"))
        return F.struct(
            F.when(earlier, edge["at"]).otherwise(seen["first"]).alias("first"),
            F.when(earlier, edge["height"]).otherwise(seen["height"]).alias("height"),
            F.when(edge["last"] & (words > seen["best"]["words"]), this).otherwise(seen["best"]).alias("best"),
        )

    return F.aggregate(F.array_sort(found), zero, step)["best"]


def overlaps(docs: DataFrame, benchmark: DataFrame, rule: Overlap = Overlap()) -> DataFrame:
    """One row per document and item that overlap: ``doc_id, key, item_id, start, words, matched`` - the
    longest stretch's first word in the document, its words and how many of them are equal.

    Null and empty texts and items under five words overlap nothing; repeated rows count once; items of
    a repeated id and items without an id are items of their own, each with its own row. Other columns are ignored; empty tables give an empty result."""
    items = materialize(items_of(benchmark))
    found = materialize(hits(docs, items))
    which = found.select(F.col("doc_id").alias("_id"), F.col("key").alias("_key")).distinct()
    if found.count() <= BROADCAST_HITS:
        which = F.broadcast(which)
    text = docs.select("doc_id", whole("text").alias("_text")).withColumn("key", F.xxhash64("_text"))
    named = text.join(which, text["doc_id"].eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key"))).dropDuplicates(["doc_id", "key"])
    words = named.select("doc_id", "key", tokens_of(F.col("_text")).alias("_tokens"))
    placed = found.join(items, "item_key").withColumnsRenamed({"doc_id": "_id", "key": "_key"})
    both = placed.join(words, placed["_id"].eqNullSafe(words["doc_id"]) & (F.col("_key") == F.col("key")))
    # get() is null outside the document, and null is no match.
    equal = F.transform(F.col("item"), lambda w, k: F.coalesce(F.get(F.col("_tokens"), F.col("diagonal") + k) == w, F.lit(False)))
    judged = both.select(
        "doc_id", "key", "item_key", "item_id", "diagonal", F.size("item").alias("n"), longest_stretch(equal, rule.price).alias("b")
    )
    needed = F.greatest(F.lit(rule.least), F.least(F.lit(rule.most), F.ceil(F.col("n") * rule.share)))
    size = F.col("b.words")
    best = F.max(F.struct(size.alias("words"), F.col("b.matched").alias("matched"), (F.col("diagonal") + F.col("b.start")).alias("start")))
    return (
        judged.where(F.when(F.col("n") < rule.least, F.col("b.matched") == F.col("n")).otherwise(size >= needed)).groupBy("doc_id", "key", "item_key").agg(F.first("item_id").alias("item_id"), best.alias("best"))
        .select("doc_id", "key", "item_id", "best.start", "best.words", "best.matched")
    )


def drop_leaks(docs: DataFrame, benchmark: DataFrame, rule: Overlap = Overlap()) -> DataFrame:
    """``docs`` without those that overlap an item, columns as they are."""
    gone = materialize(overlaps(docs, benchmark, rule).select(F.col("doc_id").alias("_id"), F.col("key").alias("_key")).distinct())
    if gone.count() <= BROADCAST_HITS:
        gone = F.broadcast(gone)
    return docs.join(
        gone, docs["doc_id"].eqNullSafe(gone["_id"]) & (F.xxhash64(whole(docs["text"])) == gone["_key"]), "left_anti"
    )
