"""Toxicity by a classifier chain.

The categories are predicted one after the other, each by a linear model over the form of a
text and the presence of telling words, and each model but the first also reads the log-odds
the earlier ones give. It is trained on out-of-fold log-odds: every training document is
judged by models that have not seen it, as documents to be scored are.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import table
from larkspur.llm.linear import SAMPLE, Model, fit, labelled, sigmoid, style
from larkspur.session import durable

FOLDS = 3
#: words each category may add to the features
LEXICON = 128
#: a word must be in this many sample documents
SUPPORT = 5
THRESHOLD = 0.5


def word_ids(text: bytes) -> np.ndarray:
    """Hashes of the distinct lower-case words of a whole text."""
    found = set(re.findall(rb"[a-z\x80-\xff]+", text.lower()))
    return np.unique(np.fromiter(map(zlib.crc32, found), dtype=np.uint32, count=len(found)))


@dataclass(frozen=True)
class Chain:
    categories: list[str]
    words: np.ndarray
    models: list[Model]

    def logits(self, x: np.ndarray) -> np.ndarray:
        """One column for each category, in the order of the chain."""
        out = np.zeros((len(x), 0))
        for model in self.models:
            out = np.c_[out, model.logit(np.c_[x, out])]
        return out

    def features(self, texts) -> np.ndarray:
        return features(texts, self.words)


def features(texts, words: np.ndarray) -> np.ndarray:
    x = np.zeros((len(texts), len(style(b"")) + len(words)))
    for row, text in zip(x, texts):
        text = text or b""
        form = style(text)
        row[: len(form)] = form
        if len(words):
            ids = word_ids(text)
            at = np.minimum(np.searchsorted(words, ids), len(words) - 1)
            row[len(form) + at[words[at] == ids]] = 1.0
    return x


def telling(words: DataFrame, category: str, rows: int, positive: int, count: int) -> list[int]:
    """The words whose shares differ most between the two classes, by a two-sample z.

    ``words`` has one row for each distinct word of a document: id and the categories.
    """
    if not 0 < positive < rows:
        return []
    seen, hit = F.count("*").cast("double"), F.sum(category).cast("double")
    rate = F.col("seen") / rows
    gap = F.col("hit") / positive - (F.col("seen") - F.col("hit")) / (rows - positive)
    z = F.abs(gap) / F.sqrt(rate * (1 - rate) * (1 / positive + 1 / (rows - positive)))
    sums = words.groupBy("id").agg(seen.alias("seen"), hit.alias("hit")).filter((F.col("seen") >= SUPPORT) & (F.col("seen") < rows))
    best = sums.select("id", z.alias("z")).filter("z > 0").orderBy(F.desc("z"), "id").limit(count)
    return [r["id"] for r in best.collect()]


def train(x: np.ndarray, y: np.ndarray, folds: np.ndarray) -> list[Model]:
    """A model for each column of ``y``; those after the first are fitted on out-of-fold log-odds."""
    models, before = [], np.zeros((len(x), 0))
    for j in range(y.shape[1]):
        own = np.c_[x, before]
        models.append(fit(own, y[:, j]))
        held_out = np.zeros(len(x))
        for f in np.unique(folds):
            held_out[folds == f] = fit(own[folds != f], y[folds != f, j]).logit(own[folds == f])
        before = np.c_[before, held_out]
    return models


def fit_chain(docs: DataFrame, labels: DataFrame, categories: list[str], sample: int = SAMPLE) -> Chain:
    """The chain, from at most ``sample`` labelled documents; ``labels`` has doc_id and 0/1 categories.

    Words are counted in tasks; the driver gets the chosen words and the features of the sample.
    """
    rows = durable(labelled(docs, labels, categories, sample))
    width = len(style(b""))

    def words_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for at in range(0, len(b), 256):
                part = b.iloc[at : at + 256]
                ids = [word_ids(t or b"").astype(np.int64) for t in part["text"]]
                many = [len(i) for i in ids]
                yield pd.DataFrame({"id": np.concatenate(ids)} | {c: np.repeat((part[c].to_numpy() > 0).astype(np.int32), many) for c in categories})

    kinds = ", ".join(f"{c} int" for c in categories)
    words = durable(rows.mapInPandas(words_of, f"id long, {kinds}"))
    sums = rows.agg(F.count("*").alias("rows"), *[F.coalesce(F.sum((F.col(c) > 0).cast("int")), F.lit(0)).alias(c) for c in categories]).first()
    chosen = {i for c in categories for i in telling(words, c, sums["rows"], sums[c], LEXICON)}
    lexicon = np.array(sorted(chosen), dtype=np.uint32)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = b[["doc_id", *categories]].copy()
            x = features(b["text"], lexicon)
            out["form"] = list(x[:, :width])
            out["present"] = [np.flatnonzero(r).astype(np.int32) for r in x[:, width:]]
            yield out

    got = rows.mapInPandas(read, f"doc_id long, {kinds}, form array<double>, present array<int>").toPandas().sort_values("doc_id")
    y = (got[categories].to_numpy() > 0).astype(float).reshape(len(got), len(categories))
    x = np.zeros((len(got), width + len(lexicon)))
    for row, form, present in zip(x, got["form"], got["present"]):
        row[:width] = form
        row[width + np.asarray(present, dtype=int)] = 1.0
    folds = np.array([zlib.crc32(str(i).encode()) % FOLDS for i in got["doc_id"]])
    return Chain(categories, lexicon, train(x, y, folds))


def score(docs: DataFrame, chain: Chain) -> DataFrame:
    """(doc_id, a probability p_<category> each); null texts count as empty, every row gets its scores."""
    names = [f"p_{c}" for c in chain.categories]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            p = sigmoid(chain.logits(chain.features(b["text"])))
            yield pd.DataFrame({"doc_id": b["doc_id"].astype("Int64")} | {n: p[:, j] for j, n in enumerate(names)})

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return read.mapInPandas(run, "doc_id long, " + ", ".join(f"{n} double" for n in names))


def classify(docs: DataFrame, labels: DataFrame, categories: list[str], sample: int = SAMPLE) -> DataFrame:
    """Scores of all documents by a chain trained on their labels.

    A category whose labels are all alike, or missing, gets the smoothed rate of its labels
    for every document. No documents give no rows; other columns are not read.
    """
    return score(docs, fit_chain(docs.select("doc_id", "text"), labels, categories, sample))


def query(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").select("doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic")
    scores = classify(table(spark, sf_dir, "documents"), labels, ["low_quality", "toxic"])
    return scores.select("doc_id", "p_low_quality", "p_toxic", (F.col("p_toxic") >= THRESHOLD).alias("toxic"))
