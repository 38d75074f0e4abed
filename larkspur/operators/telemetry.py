"""Event rows for the run log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def event_rows(df: DataFrame, trace_id: Column, timestamp: Column, record_type: Column, step: Column, attributes: Column, error: Column) -> DataFrame:
    """LOG and SPAN rows with attributes as JSON; error texts are kept whole."""
    return df.select(
        trace_id.alias("trace_id"),
        timestamp.alias("event_timestamp"),
        record_type.alias("record_type"),
        step.alias("process_step"),
        F.to_json(attributes).alias("attributes"),
        error.isNotNull().alias("error_flag"),
        error.alias("error_message"),
    )
