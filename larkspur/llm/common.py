"""Small column helpers the corpus operators share."""

from __future__ import annotations

from collections.abc import Callable
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, also where the body names it inside a lambda.

    The optimiser may inline a projected column into a lambda that uses it, which then
    computes it again for every element; a lambda variable cannot be inlined.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only; a text that is all ASCII takes the faster built-in."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, ascii_uppercase, ascii_lowercase))


def row_key(text: str = "text") -> list[Column]:
    """(k_id, k_text): joins results back to documents whose doc_id may be null or repeated.

    Rows that agree in both have the same text, so whatever depends on the text alone agrees too.
    """
    return [F.coalesce("doc_id", F.lit(0)).alias("k_id"), F.xxhash64(text).alias("k_text")]


KEY = ["k_id", "k_text"]


def keyed(docs: DataFrame, text: str = "text") -> DataFrame:
    """The key beside the whole row as one struct, so that no column name can clash."""
    return docs.select(F.struct("*").alias("own"), *row_key(text))
