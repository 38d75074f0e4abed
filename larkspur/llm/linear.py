"""Logistic models over document features: fitted from a bounded sample, applied in tasks."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: labelled documents a model is fitted on, at most; they are picked by a hash of their id
SAMPLE = 10_000

STYLE = (
    "log words, bytes a word, upper-case share, symbols a byte, points and commas a word, digits a byte, "
    "exclamation marks a word, bars a word, distinct words, distinct lines, log words a line"
).split(", ")


def style(text: bytes) -> list[float]:
    """Signals of form: all zero but for the shares of distinct words and lines if there is no word."""
    seen = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    words, lines = text.split(), text.split(b"\n")
    size, n = max(len(text), 1), max(len(words), 1)
    upper, lower, beyond, digits = seen[65:91].sum(), seen[97:123].sum(), seen[128:].sum(), seen[48:58].sum()
    points = seen[44] + seen[46]
    symbols = seen[33:127].sum() - upper - lower - digits - points
    return [
        float(np.log1p(len(words))),
        len(text) / n,
        upper / (upper + lower + beyond + 1),
        symbols / size,
        points / n,
        digits / size,
        seen[33] / n,
        seen[124] / n,
        len(set(words)) / n if words else 1.0,
        len(set(lines)) / len(lines),
        float(np.log1p(len(words) / len(lines))),
    ]


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip(x @ self.weights + self.bias, -30.0, 30.0)


def sigmoid(z):
    return 1.0 / (1.0 + np.exp(-z))


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 25) -> Model:
    """Penalised logistic regression by Newton steps; the smoothed rate alone if one class is absent."""
    x, y = np.asarray(x, dtype=np.float64), np.asarray(y, dtype=np.float64)
    width = x.shape[1] if x.ndim == 2 else 0
    if len(y) == 0 or y.min() == y.max():
        rate = (y.sum() + 1) / (len(y) + 2)
        return Model(np.zeros(width), float(np.log(rate / (1 - rate))))
    mean, spread = x.mean(axis=0), x.std(axis=0)
    spread[spread < 1e-12] = 1.0
    z = np.c_[np.ones(len(x)), (x - mean) / spread]
    penalty = np.r_[1e-6, np.full(width, ridge)]
    w = np.zeros(width + 1)
    for _ in range(rounds):
        p = sigmoid(np.clip(z @ w, -30, 30))
        slope = z.T @ (y - p) - penalty * w
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty), slope)
        w += step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    raw = w[1:] / spread
    return Model(raw, float(w[0] - raw @ mean))


def labelled(docs: DataFrame, labels: DataFrame, names: list[str], sample: int = SAMPLE) -> DataFrame:
    """(doc_id, label columns, text) of at most ``sample`` labelled ids.

    Rows with a null id or label are no label; of several labels of a document the smallest counts.
    Of several rows of a document one counts, the one whose text has the least hash.
    """
    clean = labels.select(F.col("doc_id").alias("l_id"), *names).na.drop()
    one = clean.groupBy("l_id").agg(*[F.min(n).cast("int").alias(n) for n in names])
    picked = one.orderBy(F.xxhash64("l_id"), "l_id").limit(sample)
    # at most ``sample`` rows of a few numbers
    rows = docs.join(F.broadcast(picked), docs["doc_id"] == F.col("l_id")).select("doc_id", *names, F.col("text").cast("binary").alias("text"))
    least = F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")
    return rows.groupBy("doc_id").agg(*[F.min(n).alias(n) for n in names], least)
