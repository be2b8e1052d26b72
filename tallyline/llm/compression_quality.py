"""Quality by compression: which dictionary, of good or of bad texts, shortens a text more.

Zstandard dictionaries are built from good and from bad labelled texts. A text's blocks are compressed
with both; the difference of the sizes over the text's length, summed over all blocks, becomes a
probability by a logistic curve fitted on labelled texts that are in neither dictionary.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import folded_fraction, training_rows

TRAINING_ROWS = 6_000  # the most labelled texts a model is fitted on
DICTIONARY_TEXTS = 700  # of a class, and at most half of its texts; the others fit the curve
DICTIONARY_BYTES = 112_640
BLOCK = 1024
LEVEL = 3


@dataclass(frozen=True)
class Model:
    """Dictionaries of bad and good texts, and the curve's slope and constant."""

    bad: bytes
    good: bytes
    slope: float
    constant: float


def blocks(text: str) -> list[bytes]:
    raw = text.encode()
    return [raw[at : at + BLOCK] for at in range(0, len(raw), BLOCK)]


def dictionary(texts: list[str]) -> bytes:
    """A trained dictionary; where there is too little text to train on, the text itself."""
    samples = [block for text in texts for block in blocks(text)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:]


class Compared:
    def __init__(self, bad: bytes, good: bytes):
        self.bad, self.good = self.compressor(bad), self.compressor(good)

    @staticmethod
    def compressor(raw: bytes) -> zstandard.ZstdCompressor:
        plain = {"level": LEVEL, "write_checksum": False, "write_content_size": False, "write_dict_id": False}
        if not raw:
            return zstandard.ZstdCompressor(**plain)
        made = zstandard.ZstdCompressionDict(raw)
        made.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(dict_data=made, **plain)

    def difference(self, text: str) -> float:
        """Size with the bad dictionary less that with the good one, per byte; 0 for the empty text."""
        cut = blocks(text)
        if not cut:
            return 0.0
        saved = sum(len(self.bad.compress(b)) - len(self.good.compress(b)) for b in cut)
        return saved / sum(map(len, cut))


def curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and constant of the logistic curve of y over x, lightly held to 0, by Newton's method."""
    rows = np.column_stack([x, np.ones(len(x))])
    found, ridge = np.zeros(2), np.diag([1e-4, 1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(rows @ found, -30, 30)))
        slope = rows.T @ (y - p) - ridge @ found
        bend = (rows * (p * (1 - p))[:, None]).T @ rows + ridge
        step = np.linalg.solve(bend, slope)
        found = found + step * min(1.0, 50 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-6:
            break
    return float(found[0]), float(found[1])


def fit(texts: list[str], labels: np.ndarray) -> Model:
    of = {label: [t for t, found in zip(texts, labels) if found == label] for label in (0, 1)}
    used = {label: min(DICTIONARY_TEXTS, (len(t) + 1) // 2) for label, t in of.items()}
    bad, good = (dictionary(of[label][: used[label]]) for label in (0, 1))
    compared = Compared(bad, good)
    rest = [(compared.difference(t), label) for label in (0, 1) for t in of[label][used[label] :]]
    if not of[0] or not of[1] or not rest:
        share = (len(of[1]) + 1) / (len(texts) + 2)
        return Model(b"", b"", 0.0, float(np.log(share / (1 - share))))
    x, y = np.array(rest).T
    # Dictionaries take a larger share of the rarer class; the curve is fitted at the labels' own shares.
    return Model(bad, good, *curve(x * 100, y))


def train(docs: DataFrame, labels: DataFrame, limit: int = TRAINING_ROWS) -> Model:
    """A model from at most ``limit`` labelled texts, fitted in one task. Without labels, or with one
    class alone, a constant near the share of the good ones."""

    def fitted(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["rank", "text"])
        model = fit(rows["text"].tolist(), rows["label"].to_numpy())
        return pd.DataFrame([model.__dict__])

    rows = training_rows(docs, labels, "quality", limit)
    made = rows.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(fitted, "bad binary, good binary, slope double, constant double").collect()
    return Model(**{k: bytes(v) if isinstance(v, bytearray) else v for k, v in made[0].asDict().items()}) if made else Model(b"", b"", 0.0, 0.0)


def rate(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, score, predicted``.

    Null and empty texts get the curve's value at no difference. Null ids count as held out. Other
    columns are never read; repeated rows are scored each; an empty table gives an empty result. Nothing
    is shuffled; the model (two dictionaries) is broadcast."""
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
        model = Model(**shared.value)
        compared = Compared(model.bad, model.good)
        for batch in batches:
            x = np.array([compared.difference(text.as_py()) for text in batch.column(1)], dtype=np.float64)
            p = 1 / (1 + np.exp(-np.clip(x * 100 * model.slope + model.constant, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p, pa.float64())], names=["doc_id", "score"])

    return run
