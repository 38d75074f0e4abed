"""Upserts, updates, deletes and versioned dimensions on immutable files."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.operators.ordered import numbered
from larkspur.session import durable

OPEN_END = "9999-12-31"


def merge_upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """MERGE: source rows replace target rows with the same keys, others are kept or added."""
    return target.join(source.select(*keys), keys, "left_anti").unionByName(source)


def update_where(df: DataFrame, cond: Column, changes: dict[str, Column]) -> DataFrame:
    """UPDATE ... SET ... WHERE; the condition sees the old values only."""
    new = {name: F.when(cond, value).otherwise(F.col(name)).cast(df.schema[name].dataType) for name, value in changes.items()}
    return df.withColumns(new)


def delete_where(df: DataFrame, cond: Column) -> DataFrame:
    """DELETE ... WHERE; rows for which the condition is unknown stay."""
    return df.filter(~F.coalesce(cond, F.lit(False)))


def keep_recent(df: DataFrame, col: str, days: int) -> DataFrame:
    """Drop rows more than ``days`` before the newest one; the newest date is a scalar subquery."""
    newest = df.agg(F.max(col)).scalar()
    return df.filter(F.col(col) >= F.date_sub(newest, days))


def with_surrogate_keys(rows: DataFrame, dim: DataFrame, sk: str, order: list[str]) -> DataFrame:
    """Number new dimension rows after the largest key in use."""
    top = dim.agg(F.coalesce(F.max(sk), F.lit(0))).scalar()
    return numbered(rows, order, "_n").withColumn(sk, F.col("_n") + top).drop("_n")


def _version(rows: DataFrame, as_of: date) -> DataFrame:
    return rows.withColumns(
        {
            "effective_date": F.lit(as_of),
            "end_date": F.to_date(F.lit(OPEN_END)),
            "is_current": F.lit(True),
        }
    )


def scd2_apply(dim: DataFrame, changes: DataFrame, key: str, sk: str, attributes: list[str], as_of: date) -> DataFrame:
    """Apply a change log to a versioned dimension.

    The current row of an updated key is closed the day before ``as_of`` and a new
    version is added; keys without a current row get their first version. The changes
    are stored once, so that the three branches read one set of them, and a rerun with
    no changes adds nothing.
    """
    arrived = durable(changes.filter("action = 'INSERT'").select(key, "is_update", *attributes))
    updated = arrived.filter("is_update").select(key)
    closing = dim.filter("is_current").join(updated, key, "left_semi")
    closed = closing.withColumns({"end_date": F.lit(as_of - timedelta(days=1)), "is_current": F.lit(False)})
    kept = dim.join(closing.select(sk), sk, "left_anti")
    still_current = kept.filter("is_current").select(key)
    fresh = _version(arrived.select(key, *attributes).join(still_current, key, "left_anti"), as_of)
    fresh = with_surrogate_keys(fresh, dim, sk, [key])
    return kept.unionByName(closed).unionByName(fresh.select(*dim.columns))


def initial_load(dim: DataFrame, source: DataFrame, key: str, sk: str, effective: Column) -> DataFrame:
    """First versions of keys the dimension lacks; safe to run again."""
    missing = source.join(dim.select(key), key, "left_anti")
    fresh = missing.withColumns(
        {"effective_date": effective, "end_date": F.to_date(F.lit(OPEN_END)), "is_current": F.lit(True)}
    )
    return dim.unionByName(with_surrogate_keys(fresh, dim, sk, [key]).select(*dim.columns))
