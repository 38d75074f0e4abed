"""Apply a caller's completion function to a text column, batch by batch in Arrow."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

CompletionFn = Callable[[pd.Series], pd.Series]


def complete_columns(df: DataFrame, steps: list[tuple[str, str, CompletionFn]]) -> DataFrame:
    """Adds one text column per (input, output, function) step; a step may read an earlier output.

    All steps run on the same Arrow batch, so rows cross to Python and back once, and
    nothing is gathered.
    """
    added = [T.StructField(output, T.StringType()) for _, output, _ in steps]
    schema = T.StructType([*df.schema.fields, *added])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for source, output, fn in steps:
                batch = batch.assign(**{output: fn(batch[source])})
            yield batch

    return df.mapInPandas(run, schema)
