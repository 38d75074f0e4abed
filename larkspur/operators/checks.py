"""Data-quality checks: many rules per source, one pass over it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALERT_COLUMNS = ("alert_name", "severity", "category", "message", "record_count", "affected_table")


@dataclass(frozen=True)
class Rule:
    name: str
    severity: str
    message: str
    source: str
    bad: Column | None = None
    category: str = "DATA_QUALITY"


def run_rules(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """One alert row per broken rule, from a single aggregation over the source."""
    counted = [
        F.struct(
            F.lit(r.name).alias("alert_name"),
            F.lit(r.severity).alias("severity"),
            F.lit(r.category).alias("category"),
            F.lit(r.message).alias("message"),
            F.count_if(r.bad).alias("record_count"),
            F.lit(r.source).alias("affected_table"),
        )
        for r in rules
    ]
    return df.agg(F.array(*counted).alias("rows")).select(F.inline("rows")).filter("record_count > 0")


def alert_if_any(counted: DataFrame, rule: Rule) -> DataFrame:
    """Alert from a frame that already holds the count in ``record_count``."""
    return counted.filter("record_count > 0").select(
        F.lit(rule.name).alias("alert_name"),
        F.lit(rule.severity).alias("severity"),
        F.lit(rule.category).alias("category"),
        F.lit(rule.message).alias("message"),
        F.col("record_count").cast("bigint").alias("record_count"),
        F.lit(rule.source).alias("affected_table"),
    )


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys seen more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt")).filter("cnt > 1")


def excess_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    return duplicates(df, keys).agg(F.coalesce(F.sum(F.col("cnt") - 1), F.lit(0)).alias("record_count"))


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows without a parent; the parent side is one row per key."""
    return child.join(parent.select(key).distinct(), key, "left_anti")
