"""Exact quantiles against numpy and plain Python, hot groups included; joins and counts on values the lists do not name."""

import statistics
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from larkspur.functions.dialect import token_counts
from larkspur.operators.quantiles import exact_quantiles
from larkspur.plans.classifier import boosted, train_score
from larkspur.registry import callables


@pytest.fixture(scope="module")
def values(spark):
    rng = np.random.default_rng(6)
    rows = [(int(g), float(v)) for g, v in zip(rng.integers(0, 4, 300), rng.integers(0, 12, 300) / 4)]
    rows += [(7, float(v)) for v in rng.normal(size=3000).round(2)]  # one group with most of the rows
    rows += [(None, 1.0), (None, 2.0), (8, None), (9, 5.0)]
    return rows


def test_quantiles(spark, values):
    df = spark.createDataFrame(values, "g int, v double").repartition(5)
    got = {r["g"]: r for r in exact_quantiles(df, ["g"], "v", {"med": 0.5, "p9": 0.9, "p0": 0.0, "p1": 1.0}, {"d9": 0.9, "d0": 0.0}, "mode").collect()}
    groups = {}
    for g, v in values:
        if v is not None:
            groups.setdefault(g, []).append(v)
    assert set(got) == set(groups)
    for g, own in groups.items():
        own = sorted(own)
        r = got[g]
        assert r["med"] == pytest.approx(np.quantile(own, 0.5)) and r["p9"] == pytest.approx(np.quantile(own, 0.9))
        assert (r["p0"], r["p1"], r["d0"]) == (own[0], own[-1], own[0])
        assert r["d9"] == own[int(np.ceil(0.9 * len(own))) - 1]
        assert r["mode"] == min(statistics.multimode(own))


def test_hot_group_is_split(spark):
    """A group of distinct values that holds nearly all rows lies in several blocks."""
    df = spark.range(100_000).select(F.lit(1).alias("g"), F.col("id").alias("v"))
    plan = exact_quantiles(df, ["g"], "v", {"med": 0.5}, {})
    assert plan.collect()[0]["med"] == 49_999.5
    from larkspur.operators.ordered import BLOCK, blocked

    counts = df.groupBy("g", "v").agg(F.count(F.lit(1)).alias("_n"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert blocked(counts, ["g"], ["v"]).select(BLOCK).distinct().count() > 4
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_token_counts(spark):
    df = spark.createDataFrame([("b a  b\nc b",), ("",), (None,), ("  ",), ("a",)], "t string")
    got = [None if r[0] is None else sorted((x["token"], x["n"]) for x in r[0]) for r in df.select(token_counts("t", " \n")).collect()]
    assert got == [[("a", 1), ("b", 3), ("c", 1)], None, None, None, [("a", 1)]]


@pytest.fixture(scope="module")
def altered(spark, small, tmp_path_factory):
    """The small tables with a sixth and a missing priority, and two customers of one name."""
    out = tmp_path_factory.mktemp("altered")
    for name in "region nation customer supplier part lineitem orders".split():
        df = spark.read.parquet(f"{small}/{name}.parquet")
        if name == "orders":
            key = F.col("o_orderkey")
            df = df.withColumn("o_orderpriority", F.when(key % 5 == 0, "6-NEW").when(key % 5 != 1, F.col("o_orderpriority")))
            late = F.lit(datetime(2001, 7, 20)).cast("timestamp_ntz")
            df = df.withColumns({"o_orderdate": F.when(key % 3 == 0, late).otherwise(F.col("o_orderdate")), "o_orderstatus": F.lit("F")})
        if name == "customer":
            df = df.withColumns({"c_name": F.lit("Same Name"), "c_mktsegment": F.lit("BUILDING"), "c_nationkey": F.lit(1)})
        df.coalesce(1).write.parquet(f"{out}/{name}.parquet")
    return str(out)


def test_unknown_codes_are_counted(spark, altered):
    found = callables()["join_cross"](spark, altered)
    assert found.agg(F.sum("orders")).first()[0] == spark.read.parquet(f"{altered}/orders.parquet").count()
    days = found.select("order_date").distinct().count()
    assert found.count() == days * found.select("payment_method").distinct().count()


def test_customers_of_one_name_stay_apart(spark, altered):
    rows = callables()["bi_top_customers"](spark, altered).collect()
    assert len(rows) == 10 and {r["customer_name"] for r in rows} == {"Same Name"}


def test_boosted_trees_beat_a_forest(spark, small):
    from pyspark.ml.classification import RandomForestClassifier

    forest = RandomForestClassifier(labelCol="label", featuresCol="features", weightCol="n", numTrees=20, maxDepth=12, maxBins=64, seed=7, featureSubsetStrategy="all")
    _, plain = train_score(spark, small, forest)
    _, better = train_score(spark, small, boosted(8, 7))
    assert better >= plain - 1e-9 and better > 0.8, (plain, better)


def test_codes_without_a_name_keep_their_own(spark, altered):
    from larkspur import domain as D

    names = {r["payment_method"] for r in D.orders(spark, altered).select("payment_method").distinct().collect()}
    assert "6-NEW" in names and None in names and "Credit Card" in names
    key = F.col("o_orderkey") % 5 == 0
    want = spark.read.parquet(f"{altered}/orders.parquet").filter(key).count()
    assert D.orders(spark, altered, payment="6-NEW").count() == want > 0


def test_alert_names_its_limit():
    from larkspur.plans import quality as Q

    assert "(>$250)" in Q.amount_anomaly(datetime(2001, 7, 1), limit=250).message
    assert "(>$1000)" in Q.amount_anomaly(datetime(2001, 7, 1)).message


def test_table_function_from_sql(spark, small):
    from larkspur.plans.udfs import register_prices_above

    register_prices_above(spark, small)
    every = spark.sql("SELECT count(*) AS n FROM menu_prices_above(0)").first()["n"]
    some = spark.sql("SELECT t.item FROM menu_prices_above(940) t WHERE t.price < 1000000")
    assert 0 < some.count() < every


def test_long_conversations_are_packed_in_parts(spark, tmp_path):
    from larkspur.plans.prompts import packed_history

    rows = [(1, t, "user", f"m{t:04d}") for t in range(1234)] + [(2, 0, "user", "a"), (2, 0, "tool", "b"), (2, 1, "user", "c"), (None, 1, "user", "d")]
    path = tmp_path / "conversations.parquet"
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(6).write.parquet(str(path))
    got = {(r["conv_id"], r["part"]): [m["content"] for m in r["messages"]] for r in packed_history(spark, str(tmp_path), 500).collect()}
    assert [len(got[1, p]) for p in range(3)] == [500, 500, 234]
    assert got[1, 0] + got[1, 1] + got[1, 2] == [f"m{t:04d}" for t in range(1234)]
    assert sorted(got[2, 0]) == ["a", "b", "c"] and got[2, 0][-1] == "c" and got[None, 0] == ["d"]
