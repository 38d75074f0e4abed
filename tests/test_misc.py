"""Approximate aggregates, random columns, splits, prompts and plan shapes."""

import json

from pyspark.sql import functions as F

from larkspur import domain as D
from larkspur.functions.completion import complete_columns
from larkspur.plans import aggregates, bi, classifier, datasets, files, prompts, quality, telemetry


def plan(df):
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", 10000)
    return df._jdf.queryExecution().executedPlan().toString()


def test_approximations_are_close(spark, small):
    keys = list(aggregates.KEYS)
    exact = D.table(spark, small, "lineitem").groupBy(*keys).agg(
        F.count_distinct("l_orderkey").alias("exact"), F.median("l_extendedprice").alias("mid")
    )
    for r in aggregates.aggf_approx(spark, small).join(exact, keys).collect():
        assert abs(r.orders - r.exact) <= 0.1 * r.exact
        assert abs(r.median_price - r.mid) <= 0.02 * r.mid
        assert len(json.loads(r.top_lines)) == 3


def test_random_columns_have_their_shape(spark, small):
    df = files.random_columns(spark, small)
    row = df.agg(F.avg("uniform"), F.avg("normal"), F.stddev("normal"), F.min("zipf"), F.max("zipf"), F.count_if(F.col("zipf") == 1), F.count_if(F.col("zipf") == 2), F.count_distinct("id"), F.count(F.lit(1))).first()
    assert 0.3 < row[0] < 0.7 and abs(row[1]) < 0.4 and 0.7 < row[2] < 1.3
    assert row[3] >= 1 and row[4] <= files.ZIPF_RANKS and row[5] > row[6] and row[7] == row[8]


def test_split_is_a_partition(spark, small):
    rows = classifier.encoded(spark, small)
    train, test = classifier.hash_split(rows, 0.9, "month", "day")
    assert train.count() + test.count() == rows.count()
    assert 0.8 < train.count() / rows.count() < 0.97


def test_classifier_learns_the_pattern(spark):
    row = classifier.ml_train_score(spark, "/root/testdata/sf0.01").first()
    assert row.accuracy >= 0.9 and row.test_rows > 10


def test_long_conversations_continue_in_parts(spark, small):
    parts = prompts.packed_history(spark, small, 2)
    whole = prompts.packed_history(spark, small, 500)
    assert parts.agg(F.max(F.size("messages"))).first()[0] == 2
    assert parts.agg(F.sum(F.size("messages"))).first() == whole.agg(F.sum(F.size("messages"))).first()
    assert whole.agg(F.sum(F.size("messages"))).first()[0] == D.table(spark, small, "conversations").count()


def test_completion_keeps_rows(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, p string")
    got = complete_columns(df, [("p", "out", lambda s: s.fillna("?").str.upper()), ("out", "twice", lambda s: s + s)])
    assert {tuple(r) for r in got.collect()} == {(1, "a", "A", "AA"), (2, None, "?", "??")}


def test_filters_reach_the_scan(spark, small):
    text = plan(bi.bi_top_customers(spark, small))
    assert "EqualTo(o_orderstatus,F)" in text or "In(o_orderstatus, [F])" in text
    assert "GreaterThanOrEqual(o_orderdate,2001-07-02" in text
    text = plan(datasets.city_sales_range(spark, small))
    assert "GreaterThanOrEqual(o_orderdate,1996-12-31" in text


def test_recent_checks_do_not_scan_old_days(spark, small):
    assert "GreaterThanOrEqual(o_orderdate,2000-06-30" in plan(quality.dq_run_all(spark, small))
    assert "GreaterThan(ts,2024-01-23" in plan(telemetry.tel_performance(spark, small)) or "GreaterThan(ts,2024-01-24" in plan(telemetry.tel_performance(spark, small))


def test_scans_read_only_needed_columns(spark, small):
    text = plan(bi.bi_segment(spark, small))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string>" in text
    assert "l_shipdate" not in text and "c_name" not in text
