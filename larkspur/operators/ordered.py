"""Window results over groups of any size.

A plain window sorts a whole group in one task, so a key that holds a third of the
rows becomes the job. Here rows are range-partitioned by (keys, order) into blocks of
similar size, which splits a hot key over many tasks; the usual Spark window runs
inside (keys, block) and a small per-block summary carries totals from block to block.
Rows with equal (keys, order) values always share a block, so ties stay together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.session import durable

BLOCK = "_blk"


def _cols(names) -> list[Column]:
    return [F.col(n) if isinstance(n, str) else n for n in names]


def blocked(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """Adds a block number that grows with (keys, order).

    The range bounds are sampled, so the block number is written to shared storage
    once: a lost executor or a second job must not see other bounds.
    """
    sort = [*_cols(keys), *_cols(order)]
    ranged = df.repartitionByRange(*sort).withColumn(BLOCK, F.spark_partition_id())
    return durable(ranged)


def _carry(summary: DataFrame, keys: list[str], sums: dict[str, str]) -> DataFrame:
    """Running totals of earlier blocks of the same key; a key has at most one row per block here."""
    before = Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    out = [*keys, BLOCK]
    for name, how in sums.items():
        agg = getattr(F, how)
        out.append(agg(name).over(before).alias(f"_before_{name}"))
        out.append(agg(name).over(whole).alias(f"_all_{name}"))
    return summary.select(*out)


def _with_carry(rows: DataFrame, carry: DataFrame, keys: list[str]) -> DataFrame:
    """Null-safe join back on (keys, block); row counts are those of ``rows``."""
    names = [*keys, BLOCK]
    renamed = carry.select(*[F.col(n).alias(f"_c_{n}") if n in names else F.col(n) for n in carry.columns])
    cond = None
    for n in names:
        test = F.col(n).eqNullSafe(F.col(f"_c_{n}"))
        cond = test if cond is None else cond & test
    return rows.join(renamed, cond).drop(*[f"_c_{n}" for n in names])


def ranks(df: DataFrame, keys: list[str], order: list, tiles: int = 4) -> DataFrame:
    """Adds row_number, rank, dense_rank, percent_rank, cume_dist, ntile and the group size."""
    rows = blocked(df, keys, order)
    w = Window.partitionBy(*keys, BLOCK).orderBy(*_cols(order))
    local = rows.select(
        "*",
        F.row_number().over(w).alias("_rn"),
        F.rank().over(w).alias("_rk"),
        F.dense_rank().over(w).alias("_dr"),
        F.count(F.lit(1)).over(w.rangeBetween(Window.unboundedPreceding, 0)).alias("_upto"),
    )
    summary = local.groupBy(*keys, BLOCK).agg(F.count(F.lit(1)).alias("n"), F.max("_dr").alias("d"))
    joined = _with_carry(local, _carry(summary, keys, {"n": "sum", "d": "sum"}), keys)
    before = F.coalesce("_before_n", F.lit(0))
    rn, rank, total = before + F.col("_rn"), before + F.col("_rk"), F.col("_all_n")
    base, extra = F.floor(total / tiles), total % tiles
    edge = extra * (base + 1)
    tile = F.when(rn <= edge, F.ceil(rn / (base + 1))).otherwise(extra + F.ceil((rn - edge) / F.greatest(base, F.lit(1))))
    return joined.select(
        *df.columns,
        rn.alias("row_number"),
        rank.alias("rank"),
        (F.coalesce("_before_d", F.lit(0)) + F.col("_dr")).alias("dense_rank"),
        F.when(total > 1, (rank - 1).cast("double") / (total - 1)).otherwise(F.lit(0.0)).alias("percent_rank"),
        ((before + F.col("_upto")).cast("double") / total).alias("cume_dist"),
        tile.cast("bigint").alias("ntile"),
        total.alias("group_rows"),
    )


def numbered(df: DataFrame, order: list, alias: str, start: int = 1, step: int = 1, keys: list[str] | None = None) -> DataFrame:
    """Dense numbers ``start, start+step, ...`` in the given order, over all rows or per key."""
    if not keys:
        return _numbered_all(df, order, alias, start, step)
    rows = blocked(df, keys, order)
    local = rows.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys, BLOCK).orderBy(*_cols(order))))
    summary = rows.groupBy(*keys, BLOCK).agg(F.count(F.lit(1)).alias("n"))
    joined = _with_carry(local, _carry(summary, keys, {"n": "sum"}), keys)
    position = F.coalesce("_before_n", F.lit(0)) + F.col("_rn") - 1
    return joined.select(*df.columns, (position * step + start).alias(alias))


def _numbered_all(df: DataFrame, order: list, alias: str, start: int, step: int) -> DataFrame:
    """One range shuffle: rows are sorted inside their block and numbered as they are stored."""
    sort = _cols(order)
    stored = durable(
        df.repartitionByRange(*sort).sortWithinPartitions(*sort).withColumn("_m", F.monotonically_increasing_id())
    )
    # the generated id holds the block in the upper bits and the place inside it in the lower 33
    rows = stored.withColumns({BLOCK: F.shiftright("_m", 33), "_i": F.col("_m").bitwiseAND((1 << 33) - 1)})
    sizes = rows.groupBy(BLOCK).agg(F.count(F.lit(1)).alias("n"))
    # one row per block, so at most as many as there are shuffle partitions
    carry = _carry(sizes, [], {"n": "sum"}).withColumnRenamed(BLOCK, "_c_blk")
    joined = rows.join(carry, F.col(BLOCK) == F.col("_c_blk"))
    position = F.coalesce("_before_n", F.lit(0)) + F.col("_i")
    return joined.select(*df.columns, (position * step + start).alias(alias))


def running(df: DataFrame, keys: list[str], order: list, value: str) -> DataFrame:
    """Adds running sum, avg, count, min and max of ``value``; rows that tie share a value."""
    rows = blocked(df, keys, order)
    w = Window.partitionBy(*keys, BLOCK).orderBy(*_cols(order)).rangeBetween(Window.unboundedPreceding, 0)
    local = rows.select(
        "*",
        F.sum(value).over(w).alias("_sum"),
        F.count(value).over(w).alias("_count"),
        F.min(value).over(w).alias("_min"),
        F.max(value).over(w).alias("_max"),
    )
    summary = rows.groupBy(*keys, BLOCK).agg(
        F.sum(value).alias("s"), F.count(value).alias("c"), F.min(value).alias("lo"), F.max(value).alias("hi")
    )
    carry = _carry(summary, keys, {"s": "sum", "c": "sum", "lo": "min", "hi": "max"})
    joined = _with_carry(local, carry, keys)
    # null only while no value has been seen
    total = F.coalesce(F.col("_before_s") + F.col("_sum"), F.col("_before_s"), F.col("_sum"))
    count = F.coalesce("_before_c", F.lit(0)) + F.col("_count")
    return joined.select(
        *df.columns,
        total.alias("running_sum"),
        count.alias("running_count"),
        F.try_divide(total.cast("double"), F.nullif(count, F.lit(0))).alias("running_avg"),
        F.least("_before_lo", "_min").alias("running_min"),
        F.greatest("_before_hi", "_max").alias("running_max"),
    )


def neighbours(df: DataFrame, keys: list[str], order: list, value: str, wanted: dict[str, tuple[int, object]], chunk: int = 100_000) -> DataFrame:
    """Adds offset values: ``wanted`` maps an alias to (offset, default); a negative offset looks ahead.

    Numbered rows are cut into chunks, at least twice the largest offset, and every chunk borrows as many rows
    on either side as the largest offset, so the window inside a chunk sees all it needs.
    """
    halo = max(abs(offset) for offset, _ in wanted.values())
    chunk = max(chunk, 2 * halo)
    rows = numbered(df, order, "_pos", start=0, keys=keys)
    home = F.floor(F.col("_pos") / chunk)
    inside = F.col("_pos") % chunk
    places = F.array_compact(
        F.array(
            home,
            F.when(inside < halo, home - 1),
            F.when(inside >= chunk - halo, home + 1),
        )
    )
    spread = rows.select("*", home.alias("_home"), F.explode(places).alias("_chunk"))
    w = Window.partitionBy(*keys, "_chunk").orderBy("_pos")
    offsets = [
        (F.lag(value, offset, default) if offset > 0 else F.lead(value, -offset, default)).over(w).alias(alias)
        for alias, (offset, default) in wanted.items()
    ]
    return spread.select("*", *offsets).filter("_chunk = _home").select(*df.columns, *wanted)
