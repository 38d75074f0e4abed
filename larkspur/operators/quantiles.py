"""Exact quantiles and modes of groups of any size.

A group's values never meet in one buffer: equal values are counted before the shuffle, the
counts are range-partitioned by (group, value) into blocks, running counts go from block to
block, and the values at the wanted ranks are picked where they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.operators.ordered import BLOCK, _carry, _with_carry, blocked


def exact_quantiles(df: DataFrame, keys: list[str], value: str, continuous: dict[str, float], discrete: dict[str, float], mode: str | None = None) -> DataFrame:
    """One row per group: ``continuous`` names interpolated quantiles, ``discrete`` ones that are values; nulls do not count.

    The mode is the most frequent value, the smallest of several. Null keys are groups; groups
    without a value have no row.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    rows = blocked(counts, keys, [value])
    upto = Window.partitionBy(*keys, BLOCK).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    local = rows.withColumn("_upto", F.sum("_n").over(upto))
    sizes = rows.groupBy(*keys, BLOCK).agg(F.sum("_n").alias("n"))
    placed = _with_carry(local, _carry(sizes, keys, {"n": "sum"}), keys)
    last = F.coalesce("_before_n", F.lit(0)) + F.col("_upto")
    first, total = last - F.col("_n"), F.col("_all_n")

    def at(rank: Column) -> Column:
        return F.max(F.when((first <= rank) & (rank < last), F.col(value)))

    found = []
    for name, p in continuous.items():
        place = F.lit(p) * (total - 1)
        share = F.max(place - F.floor(place))
        low, high = at(F.floor(place)), at(F.ceil(place))
        found.append((low + (high - low) * share).alias(name))
    for name, p in discrete.items():
        found.append(at(F.greatest(F.ceil(F.lit(p) * total), F.lit(1)) - 1).alias(name))
    if mode:
        top = F.max(F.struct("_n", (-F.col(value)).alias("v")))
        found.append((-top["v"]).alias(mode))
    return placed.groupBy(*keys).agg(*found)
