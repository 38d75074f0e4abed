"""Planted defects trip exactly their check."""

from datetime import date, datetime
from decimal import Decimal


from larkspur.operators.checks import duplicates, excess_rows, orphans, run_rules
from larkspur.plans import quality as Q

HEADER = "order_id bigint, customer_id bigint, order_ts timestamp_ntz, order_amount decimal(18,4), order_total decimal(18,4)"


def header(spark, rows):
    return spark.createDataFrame(
        [(i, c, ts, None if a is None else Decimal(a), None if t is None else Decimal(t)) for i, c, ts, a, t in rows], HEADER
    )


def test_planted_headers(spark):
    now = datetime(2001, 7, 1)
    df = header(
        spark,
        [
            (8001, None, datetime(2001, 6, 30), None, 5),
            (8002, 1, datetime(2001, 6, 30), 1500, 500000),
            (8003, 2, datetime(2001, 6, 30), 25, -25),
            (8004, 3, datetime(2001, 7, 6), 10, 10),
            (8005, 4, datetime(2001, 6, 30), 10, 10),
        ],
    )
    rules = Q.header_rules(now, hours=48)
    got = {r.alert_name: r.record_count for r in run_rules(df, rules).collect()}
    assert got == {"ORDER_MISSING_CRITICAL_VALUES": 1, "ORDER_AMOUNT_ANOMALY": 1, "NEGATIVE_ORDER_TOTAL": 1, "FUTURE_DATED_ORDERS": 1}
    assert run_rules(df.filter("order_id = 8005"), rules).count() == 0


def test_emails(spark):
    new, old = date(2024, 1, 2), date(2023, 1, 2)
    rows = [(None, new), ("", new), ("nobody", new), ("a@b", new), ("nobody", old)]
    df = spark.createDataFrame(rows, "e_mail string, sign_up_date date")
    assert run_rules(df, [Q.invalid_email(date(2024, 1, 2))]).first().record_count == 3


def test_prices(spark):
    df = spark.createDataFrame([(10, 1), (10, 2), (10, 10), (10, 11)], "sale_price_usd int, cost_of_goods_usd int")
    assert run_rules(df, [Q.price_rule()]).first().record_count == 2


def test_duplicates_count_the_excess(spark):
    df = spark.createDataFrame([(1, None)] * 3 + [(2, 5)] * 2 + [(3, 1)], "a int, b int")
    assert excess_rows(df, ["a", "b"]).first().record_count == 3
    assert duplicates(df, ["a", "b"]).count() == 2
    assert excess_rows(df.filter("a = 3"), ["a", "b"]).first().record_count == 0


def test_orphans(spark):
    child = spark.createDataFrame([(1,), (1,), (2,)], "order_id int")
    parent = spark.createDataFrame([(1,), (1,)], "order_id int")
    assert [r.order_id for r in orphans(child, parent, "order_id").collect()] == [2]


def test_all_checks_equal_single_checks(spark, small):
    single = [Q.dq_missing_values, Q.dq_amount_anomaly, Q.dq_negative_total, Q.dq_orphan_headers, Q.dq_invalid_email, Q.dq_price_rule, Q.dq_duplicate_orders, Q.dq_future_dated]
    want = sorted(tuple(r) for fn in single for r in fn(spark, small).collect())
    assert sorted(tuple(r) for r in Q.dq_run_all(spark, small).select(*Q.dq_price_rule(spark, small).columns).collect()) == want
