"""Blocked windows against plain Spark windows, with a hot key and ties."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from larkspur.operators import ordered


@pytest.fixture(scope="module")
def rows(spark):
    # small inputs would be merged into one block
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield build(spark)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def build(spark):
    # key 0 holds most rows; v has ties and nulls; id is unique
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 != 0, 0).when(F.col("id") % 21 == 0, None).otherwise(F.col("id") % 11).alias("k"),
        (F.pmod(F.xxhash64("id"), F.lit(300))).alias("t"),
        F.when(F.col("id") % 10 != 0, (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000))).cast("decimal(18,4)")).alias("v"),
        F.col("id"),
    )
    return df.cache()


def same(a, b):
    assert a.columns == b.columns
    assert a.exceptAll(b).count() == 0
    assert b.exceptAll(a).count() == 0


@pytest.mark.parametrize("order", [("t", "id"), ("t",), ("-t", "id")])
def test_ranks(rows, order):
    order = [F.desc(o[1:]) if o.startswith("-") else o for o in order]
    w = Window.partitionBy("k").orderBy(*order)
    want = rows.select(
        "id",
        F.rank().over(w).cast("long").alias("rank"),
        F.dense_rank().over(w).cast("long").alias("dense_rank"),
        F.percent_rank().over(w).alias("percent_rank"),
        F.cume_dist().over(w).alias("cume_dist"),
        F.count("*").over(Window.partitionBy("k")).alias("group_rows"),
    )
    got = ordered.ranks(rows, ["k"], order).select(
        "id", F.col("rank").cast("long"), F.col("dense_rank").cast("long"), "percent_rank", "cume_dist", "group_rows"
    )
    same(got, want)


@pytest.mark.parametrize("tiles", [1, 4, 7, 6000])
def test_row_number_and_ntile(rows, tiles):
    w = Window.partitionBy("k").orderBy("t", "id")
    want = rows.select("id", F.row_number().over(w).cast("long").alias("row_number"), F.ntile(tiles).over(w).cast("long").alias("ntile"))
    got = ordered.ranks(rows, ["k"], ["t", "id"], tiles).select("id", F.col("row_number").cast("long"), "ntile")
    same(got, want)


def test_hot_key_is_split(rows):
    blocks = ordered.blocked(rows, ["k"], ["t", "id"])
    assert blocks.filter("k = 0").select(ordered.BLOCK).distinct().count() > 1


def test_numbered_global(rows):
    got = ordered.numbered(rows, [F.desc("id")], "n", start=2, step=10)
    assert got.filter(F.col("n") != (4999 - F.col("id")) * 10 + 2).count() == 0
    assert got.count() == 5000


def test_numbers_survive_recomputation(rows):
    got = ordered.numbered(rows, ["t", "id"], "n")
    first = {r.id: r.n for r in got.select("id", "n").collect()}
    second = {r.id: r.n for r in got.repartition(3).select("id", "n").collect()}
    assert first == second


def test_running(rows):
    w = Window.partitionBy("k").orderBy("t")
    want = rows.select(
        "id",
        F.sum("v").over(w).alias("running_sum"),
        F.count("v").over(w).alias("running_count"),
        F.min("v").over(w).alias("running_min"),
        F.max("v").over(w).alias("running_max"),
    )
    got = ordered.running(rows, ["k"], ["t"], "v")
    cast = F.col("running_sum").cast(want.schema["running_sum"].dataType).alias("running_sum")
    same(got.select("id", cast, "running_count", "running_min", "running_max"), want)
    averages = got.select("id", "running_avg").join(rows.select("id", F.avg("v").over(w).cast("double").alias("a")), "id")
    assert averages.filter(F.abs(F.col("running_avg") - F.col("a")) > 1e-4).count() == 0


@pytest.mark.parametrize("offset,default", [(1, None), (2, 0), (6, None)])
def test_neighbours(rows, offset, default):
    w = Window.partitionBy("k").orderBy("t", "id")
    want = rows.select("id", F.lag("v", offset, default).over(w).alias("lag_value"), F.lead("v", offset, default).over(w).alias("lead_value"))
    both = {"lag_value": (offset, default), "lead_value": (-offset, default)}
    got = ordered.neighbours(rows, ["k"], ["t", "id"], "v", both, chunk=7)
    same(got.select("id", "lag_value", "lead_value"), want)
