"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are the words, word pairs and pairs with one word between, each hashed to one of 2^20 places
and counted once per text. Training is one pass after another over a bounded sample of labelled texts,
with a learning rate per place and an L1 term that leaves few weights; only those travel to the tasks
that score the corpus.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import folded_fraction, training_rows

BITS = 20
TRAINING_ROWS = 12_000  # the most labelled texts a model is fitted on
KNOWN_WORDS = 150_000  # hashes a task remembers
CHUNK = 1 << 20  # characters scored together
WORD = re.compile(r"\w+")
SKIP, PAIR = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
SPREAD = np.uint64(0xFF51AFD7ED558CCD)


@dataclass(frozen=True)
class Rates:
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 5.0
    l2: float = 0.1
    passes: int = 4


@dataclass(frozen=True)
class Model:
    """Places with a weight, their weights, and the weight of the constant."""

    places: np.ndarray
    weights: np.ndarray
    bias: float

    def dense(self) -> np.ndarray:
        weights = np.zeros(1 << BITS, dtype=np.float32)
        weights[self.places] = self.weights
        return weights


class Hashes(dict):
    """Word -> 64-bit hash, remembered for a bounded number of words."""

    def __missing__(self, word: str) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        raw = word.encode()
        value = self[word] = zlib.crc32(raw) << 32 | zlib.crc32(raw, 0x5EED)
        return value


def places_of(texts: list[str], hashes: Hashes) -> tuple[np.ndarray, np.ndarray]:
    """Text number and place of every feature occurrence."""
    cut = [WORD.findall(text.lower()) for text in texts]
    sizes = np.fromiter(map(len, cut), dtype=np.int64, count=len(cut))
    words = np.fromiter((hashes[w] for ws in cut for w in ws), dtype=np.uint64, count=int(sizes.sum()))
    text = np.repeat(np.arange(len(texts), dtype=np.int64), sizes)
    grams, owners = [words], [text]
    for gap, salt in ((1, PAIR), (2, SKIP)):
        same = text[gap:] == text[:-gap] if len(text) > gap else np.zeros(0, dtype=bool)
        left, right = words[: len(same)], words[len(words) - len(same) :]
        grams.append(((left * salt) ^ (right * SPREAD + salt))[same])
        owners.append(text[: len(same)][same])
    every = np.concatenate(grams) * SPREAD
    return np.concatenate(owners), (every >> np.uint64(64 - BITS)).astype(np.int64)


def fit(texts: list[str], labels: np.ndarray, rates: Rates = Rates()) -> Model:
    z, n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)
    hashes = Hashes()
    rows = [np.append(np.unique(places_of([text], hashes)[1]), 1 << BITS) for text in texts]

    def weights(at: np.ndarray) -> np.ndarray:
        # The constant (the last place) is not shrunk.
        l1 = np.where(at == 1 << BITS, 0.0, rates.l1)
        shrunk = np.sign(z[at]) * l1 - z[at]
        return np.where(np.abs(z[at]) <= l1, 0.0, shrunk / ((rates.beta + np.sqrt(n[at])) / rates.alpha + rates.l2))

    for _ in range(rates.passes):
        for at, label in zip(rows, labels):
            w = weights(at)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - label
            grown = n[at] + g * g
            z[at] += g - (np.sqrt(grown) - np.sqrt(n[at])) / rates.alpha * w
            n[at] = grown
    found = weights(np.arange((1 << BITS) + 1))
    kept = np.flatnonzero(found[:-1])
    return Model(kept.astype(np.int32), found[kept].astype(np.float32), float(found[-1]))


def score(texts: list[str], weights: np.ndarray, bias: float, hashes: Hashes) -> np.ndarray:
    text, place = places_of(texts, hashes)
    heavy = weights[place] != 0
    once = np.unique(text[heavy] << BITS | place[heavy])
    total = np.bincount(once >> BITS, weights=weights[once & ((1 << BITS) - 1)], minlength=len(texts))
    return 1 / (1 + np.exp(-np.clip(total + bias, -30, 30)))


def train(docs: DataFrame, labels: DataFrame, limit: int = TRAINING_ROWS, rates: Rates = Rates()) -> Model:
    """A model from at most ``limit`` labelled texts, fitted in one task. Without labels, or with one
    class alone, a constant: the share of the toxic ones (half if there are none)."""

    def fitted(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["rank", "text"])
        model = fit(rows["text"].tolist(), rows["label"].to_numpy(), rates)
        return pd.DataFrame({"places": [model.places.tobytes()], "weights": [model.weights.tobytes()], "bias": [model.bias]})

    rows = training_rows(docs, labels, "toxic", limit)
    made = rows.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(fitted, "places binary, weights binary, bias double").collect()
    if not made:
        return Model(np.zeros(0, np.int32), np.zeros(0, np.float32), 0.0)
    return Model(np.frombuffer(made[0].places, np.int32), np.frombuffer(made[0].weights, np.float32), made[0].bias)


def rate(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, score, predicted``.

    Null and empty texts get the constant's score. Null ids count as held out. Other columns are never
    read; repeated rows are scored each; an empty table gives an empty result. Nothing is shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(dict(model.__dict__))
    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        _scorer(shared), f"doc_id {kind}, score double"
    )
    return scored.select(
        "doc_id", (folded_fraction(F.col("doc_id")) == 0).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def _scorer(shared) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, hashes = Model(**shared.value), Hashes()
        weights = model.dense()
        for batch in batches:
            scores, held, size = [], [], 0
            for text in batch.column(1):
                held.append(text.as_py())
                size += len(held[-1])
                if size >= CHUNK:
                    scores.append(score(held, weights, model.bias, hashes))
                    held, size = [], 0
            scores.append(score(held, weights, model.bias, hashes))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.concatenate(scores), pa.float64())], names=["doc_id", "score"]
            )

    return run
