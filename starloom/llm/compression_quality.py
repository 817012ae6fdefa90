"""Quality score by compression: one dictionary of good text, one of bad text; what compresses better with the good one
is good. The normalised difference of the compressed sizes becomes a probability by a logistic fit on labelled rows.

Dictionaries and fit use a bounded sample of labelled rows (SAMPLE rows of a label, of at most SAMPLE_CHARS code points
each, the first by a hash of their id). Every text is scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE, SAMPLE_CHARS = 1500, 20_000
DICTIONARY = 48 << 10
LEVEL = 3


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    weights: tuple[float, ...]
    center: tuple[float, ...]
    spread: tuple[float, ...]


def _dictionary(texts: list[bytes]) -> bytes:
    """Text that the compressor may point back to: parts of all sample texts, so that each has its share."""
    share = max(64, DICTIONARY // max(1, len(texts)))
    parts = [t[(len(t) - share) // 2 :][:share] if len(t) > share else t for t in texts]
    return b"".join(parts)[:DICTIONARY] or b"\n" * 16


class Sizes:
    """Compressed sizes of a text with either dictionary and with none."""

    def __init__(self, good: bytes, bad: bytes):
        raw = zstandard.DICT_TYPE_RAWCONTENT
        plain = {"level": LEVEL}
        self.with_good = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(good, dict_type=raw), **plain)
        self.with_bad = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(bad, dict_type=raw), **plain)
        self.alone = zstandard.ZstdCompressor(**plain)

    def features(self, text: bytes) -> list[float]:
        """The normalised size difference, how far the text compresses by itself, and its length."""
        g, b, r = len(self.with_good.compress(text)), len(self.with_bad.compress(text)), len(self.alone.compress(text))
        n = len(text) + 1
        return [(b - g) / (b + g), (b - g) / n, r / n, (r / n) ** 2, np.log(n)]


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, turns: int = 40) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(turns):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + ridge * w
        bend = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(bend, slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fitted(labelled: DataFrame, text: str = "text", label: str = "label", doc_id: str = "doc_id") -> Model:
    """A model of rows (doc_id, text, label 0 or 1); others than these labels, null and long texts are not learnt from.

    One half of the sample makes the dictionaries, the other half the calibration. Without rows of both labels the
    score is the share of label 1 (one half without any rows).
    """
    fit = labelled.filter(F.col(label).isin(0, 1) & F.col(text).isNotNull() & (F.length(text) <= SAMPLE_CHARS))
    parts = {}
    for value in (0, 1):
        rows = fit.filter(F.col(label) == value).select(F.col(text).alias("text"), F.xxhash64(F.col(doc_id)).alias("mark"))
        # Marks first, so that only texts of the sample are shuffled and sent.
        last = rows.select("mark").orderBy("mark").limit(SAMPLE).agg(F.max("mark")).first()[0]
        rows = rows.filter(F.col("mark") <= F.lit(last)).orderBy("mark", "text").limit(SAMPLE).collect() if last is not None else []
        parts[value] = [r["text"].encode() for r in rows]
    bad, good = _dictionary(parts[0][::2]), _dictionary(parts[1][::2])
    if not parts[0] or not parts[1]:
        share = 0.5 if not (parts[0] or parts[1]) else float(bool(parts[1]))
        return Model(good, bad, (0.0, 0.0, 0.0, 0.0, 0.0, {0.0: -30.0, 0.5: 0.0, 1.0: 30.0}[share]), (0.0,) * 5, (1.0,) * 5)
    sizes = Sizes(good, bad)
    rest = [(t, v) for v in (0, 1) for t in parts[v][1::2] or parts[v]]
    x, y = np.array([sizes.features(t) for t, _ in rest]), np.array([v for _, v in rest], dtype=float)
    center, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    w = _logistic(np.column_stack([(x - center) / spread, np.ones(len(x))]), y)
    return Model(good, bad, tuple(w), tuple(center), tuple(spread))


def scored(docs: DataFrame, model: Model, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, score) for every row: the probability that its label is 1. Null texts score as empty ones."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes, w = Sizes(model.good, model.bad), np.array(model.weights)
        center, spread = np.array(model.center), np.array(model.spread)
        for batch in batches:
            x = np.array([sizes.features(t or b"") for t in batch.column(1).to_pylist()]).reshape(-1, len(center))
            z = ((x - center) / spread) @ w[:-1] + w[-1]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))], ["doc_id", "score"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").cast("binary").alias("text")).mapInArrow(score, "doc_id long, score double")
