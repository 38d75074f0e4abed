"""Document quality by hierarchical empirical Bayes over hosts and paths.

A linear model reads the form of a text and gives its log-odds of being good. Grouped sums
of these probabilities over all documents say how good a host and a path within it are. A
host's rate is shrunk towards the overall rate, a path's towards that of its host, by
strengths estimated from how much rates differ beyond chance, so a site with few documents
says little. The rate of its place, without the document's own part, is the prior that
replaces the overall rate in the log-odds of the document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import table
from larkspur.llm.linear import SAMPLE, STYLE, Model, fit, labelled, style
from larkspur.session import durable

THRESHOLD = 0.5
#: limits of the strength of a prior, in documents
STRENGTHS = (1.0, 10_000.0)

_EDGE = 1e-6


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """The evidence model, from at most ``sample`` labelled documents."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"quality": b["quality"], "x": [style(t or b"") for t in b["text"]]})

    rows = labelled(docs, labels, ["quality"], sample).select("quality", "text").mapInPandas(run, "quality int, x array<double>").toPandas()
    return fit(np.array(rows["x"].tolist(), dtype=float).reshape(len(rows), len(STYLE)), (rows["quality"] > 0).to_numpy(float))


def evidence(model: Model):
    """Log-odds of a text (as binary) under the model."""
    @F.pandas_udf("double")
    def log_odds(texts: pd.Series) -> pd.Series:
        x = np.array([style(t or b"") for t in texts], dtype=float).reshape(len(texts), len(STYLE))
        return pd.Series(model.logit(x))

    return log_odds


def _strength(groups: DataFrame, prior: Column) -> DataFrame:
    """One row: the strength of a beta prior, by moments of the groups' rates (n, s) around ``prior``."""
    n, rate = F.col("n"), F.col("s") / F.col("n")
    sums = groups.agg(
        F.coalesce(F.sum(n * (rate - prior) ** 2), F.lit(0.0)).alias("spread"),
        F.coalesce(F.sum(prior * (1 - prior)), F.lit(0.0)).alias("chance"),
        F.coalesce(F.sum(n), F.lit(0)).alias("total"),
        F.coalesce(F.sum(n * prior * (1 - prior)), F.lit(0.0)).alias("noise"),
    )
    low, high = STRENGTHS
    # probabilities vary less than 0/1 outcomes would, so the chance part is an upper bound
    excess = (F.col("spread") - F.col("chance")) / F.greatest(F.col("total"), F.lit(1))
    mean = F.col("noise") / F.greatest(F.col("total"), F.lit(1))
    found = F.when(excess > _EDGE, mean / excess - 1).otherwise(high)
    return sums.select(F.least(F.greatest(found, F.lit(low)), F.lit(high)).alias("k"))


def _logit(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(_EDGE)), F.lit(1 - _EDGE))
    return F.log(p / (1 - p))


def sites(scored: DataFrame) -> DataFrame:
    """(host, path, n, s, host_n, host_s, base, host_k, path_k) from (host, path, p) of all documents."""
    paths = durable(scored.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("p").alias("s")))
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    whole = hosts.agg((F.sum("s") / F.sum("n")).alias("base")).first()["base"]
    base = F.lit(0.5 if whole is None else float(whole))
    host_k = F.lit(float(_strength(hosts, base).first()["k"]))
    host_rate = (F.col("host_s") + host_k * base) / (F.col("host_n") + host_k)
    named = paths.join(hosts.select("host", F.col("n").alias("host_n"), F.col("s").alias("host_s")), "host")
    path_k = F.lit(float(_strength(named, host_rate).first()["k"]))
    return durable(named.select("host", "path", "n", "s", "host_n", "host_s", base.alias("base"), host_k.alias("host_k"), path_k.alias("path_k")))


def posterior(logit: Column, p: Column) -> Column:
    """Probability of being good, given the site's sums without the document itself."""
    c = F.col
    host = (c("host_s") - p + c("host_k") * c("base")) / (c("host_n") - 1 + c("host_k"))
    path = (c("s") - p + c("path_k") * host) / (c("n") - 1 + c("path_k"))
    return 1 / (1 + F.exp(-(logit + _logit(path) - _logit(c("base")))))


def _placed(host: Column, path: Column) -> list[Column]:
    return [F.coalesce(host, F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path")]


def classify(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang", sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """All columns of ``docs`` with evidence, site_rate, quality and keep.

    ``host`` names the column of the site, ``path`` that of the section within it. A null
    host or path is a group of its own, a null text counts as empty and repeated rows as
    the documents they are. Without labels of both kinds the evidence is the same for all
    and nothing is rejected unless the labels are mostly bad. No documents give no rows.
    """
    names = ["doc_id", "text"]
    model = train(docs.select(*names), labels.select("doc_id", "quality"), sample)
    log_odds = evidence(model)
    text = F.col("text").cast("binary")
    first = docs.select(*_placed(F.col(host), F.col(path)), log_odds(text).alias("z"))
    places = sites(first.select("host", "path", (1 / (1 + F.exp(-F.col("z")))).alias("p")))
    places = places.select(F.col("host").alias("_host"), F.col("path").alias("_path"), *[c for c in places.columns if c not in ("host", "path")])
    own = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(docs.columns)]).alias("_doc")
    again = docs.select(own, *_placed(F.col(host), F.col(path)), log_odds(text).alias("_z"))
    joined = again.join(places, (F.col("host") == F.col("_host")) & (F.col("path") == F.col("_path")))
    p = 1 / (1 + F.exp(-F.col("_z")))
    quality = posterior(F.col("_z"), p)
    return joined.select(
        *[F.col(f"_doc.c{i}").alias(c) for i, c in enumerate(docs.columns)],
        F.col("_z").alias("evidence"),
        ((F.col("s") + F.col("path_k") * (F.col("host_s") + F.col("host_k") * F.col("base")) / (F.col("host_n") + F.col("host_k"))) / (F.col("n") + F.col("path_k"))).alias("site_rate"),
        quality.alias("quality"),
        (quality >= threshold).alias("keep"),
    )


def query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return classify(docs, table(spark, sf_dir, "labels")).select("doc_id", "evidence", "site_rate", "quality", "keep")


def stage(spark, docs, sf_dir):
    """The documents that are not rejected."""
    own = F.struct(*docs.columns).alias("own")
    rows = docs.select(own, "doc_id", "text", "lang", "source")
    return classify(rows, table(spark, sf_dir, "labels")).filter("keep").select("own.*")
