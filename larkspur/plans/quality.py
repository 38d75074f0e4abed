"""Data-quality checks over delivered headers, lines, members and menu prices."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import functions as F

from larkspur import domain as D
from larkspur.operators.checks import Rule, alert_if_any, duplicates, excess_rows, orphans, run_rules
from larkspur.plans import datasets as P
from larkspur.plans.aggregates import n_rows
from larkspur.registry import query

AS_OF = datetime(2001, 7, 1)
MEMBERS_AS_OF = date(1996, 12, 30)
# The alerts look back an hour or two; a year of the historical tables stands in for that.
YEAR_HOURS = 24 * 365

# Name, severity, category, message and table of each alert.
ALERTS = {
    "missing": (
        "ORDER_MISSING_CRITICAL_VALUES", "ERROR", "DATA_QUALITY",
        "Orders detected with missing ORDER_AMOUNT, ORDER_TOTAL, or CUSTOMER_ID", "raw_pos.order_header",
    ),
    "anomaly": (
        "ORDER_AMOUNT_ANOMALY", "WARNING", "ANOMALY_DETECTION",
        "Detected orders with unusually high amounts (>${limit})", "raw_pos.order_header",
    ),
    "negative": (
        "NEGATIVE_ORDER_TOTAL", "CRITICAL", "DATA_QUALITY",
        "Orders detected with negative total amounts - possible data corruption", "raw_pos.order_header",
    ),
    "orphan": (
        "ORPHAN_ORDER_HEADERS", "WARNING", "REFERENTIAL_INTEGRITY",
        "Order headers found without corresponding order details", "raw_pos.order_header",
    ),
    "email": (
        "CUSTOMER_INVALID_EMAIL", "WARNING", "DATA_QUALITY",
        "New customer records with missing or invalid email addresses", "raw_customer.customer_loyalty",
    ),
    "price": (
        "MENU_PRICING_ANOMALY", "WARNING", "BUSINESS_RULE",
        "Menu items with unusual pricing detected (>5x cost or below cost)", "raw_pos.menu",
    ),
    "duplicate": (
        "DUPLICATE_ORDERS_DETECTED", "WARNING", "DATA_QUALITY",
        "Potential duplicate orders detected (same customer, timestamp, and total)", "raw_pos.order_header",
    ),
    "future": (
        "FUTURE_DATED_ORDERS", "ERROR", "DATA_QUALITY",
        "Orders detected with timestamps in the future", "raw_pos.order_header",
    ),
}


# order total above which an alert is raised
AMOUNT_LIMIT = 1000


def _rule(kind: str, bad=None, **limits) -> Rule:
    name, severity, category, message, source = ALERTS[kind]
    return Rule(name, severity, message.format(**limits), source, bad, category)


def _after(col: str, moment: datetime):
    return F.col(col) > F.lit(moment).cast("timestamp_ntz")


def _recent(as_of: datetime, hours: int):
    return _after("order_ts", as_of - timedelta(hours=hours))


def missing_values(as_of: datetime, hours: int = 1) -> Rule:
    lacking = F.col("order_amount").isNull() | F.col("order_total").isNull() | F.col("customer_id").isNull()
    return _rule("missing", lacking & _recent(as_of, hours))


def amount_anomaly(as_of: datetime, hours: int = 1, limit: int = AMOUNT_LIMIT) -> Rule:
    return _rule("anomaly", (F.col("order_total") > limit) & _recent(as_of, hours), limit=limit)


def negative_total(as_of: datetime, hours: int = 1) -> Rule:
    return _rule("negative", (F.col("order_total") < 0) & _recent(as_of, hours))


def future_dated(as_of: datetime) -> Rule:
    return _rule("future", _after("order_ts", as_of))


def invalid_email(as_of: date, days: int = 1) -> Rule:
    mail = F.col("e_mail")
    unusable = mail.isNull() | (mail == "") | ~mail.like("%@%")
    return _rule("email", unusable & (F.col("sign_up_date") > F.lit(as_of - timedelta(days=days))))


def price_rule() -> Rule:
    price, cost = F.col("sale_price_usd"), F.col("cost_of_goods_usd")
    return _rule("price", (price > cost * 5) | (price < cost))


def header_rules(as_of: datetime, hours: int) -> list[Rule]:
    return [missing_values(as_of, hours), amount_anomaly(as_of, hours), negative_total(as_of, hours), future_dated(as_of)]


def recent_landing(spark, sf, as_of: datetime = AS_OF, hours: int = YEAR_HOURS):
    """Delivered headers no older than the look-back of the header rules."""
    return D.landing_header(spark, sf, since=(as_of - timedelta(hours=hours)).date())


def _alert_sql(kind: str, count: str, source: str) -> str:
    name, severity, category, message, table = ALERTS[kind]
    message = message.format(limit=AMOUNT_LIMIT)
    return (
        f"SELECT '{name}' AS alert_name, '{severity}' AS severity, '{category}' AS category, '{message}' AS message, record_count, "
        f"'{table}' AS affected_table FROM (SELECT {count} AS record_count FROM {source}) WHERE record_count > 0"
    )


LAST_YEAR = "order_ts > TIMESTAMP '2001-07-01' - INTERVAL 8760 HOUR"
SQL = {
    "dq_missing_values": _alert_sql(
        "missing", "count(*)", f"v_landing WHERE (order_amount IS NULL OR order_total IS NULL OR customer_id IS NULL) AND {LAST_YEAR}"
    ),
    "dq_amount_anomaly": _alert_sql("anomaly", "count(*)", f"v_landing WHERE order_total > {AMOUNT_LIMIT} AND {LAST_YEAR}"),
    "dq_negative_total": _alert_sql("negative", "count(*)", f"v_landing WHERE order_total < 0 AND {LAST_YEAR}"),
    "dq_orphan_headers": _alert_sql(
        "orphan", "count(*)", f"v_header WHERE order_id NOT IN (SELECT order_id FROM v_detail) AND {LAST_YEAR}"
    ),
    "dq_invalid_email": _alert_sql(
        "email", "count(*)", "v_loyalty WHERE (e_mail IS NULL OR e_mail = '' OR e_mail NOT LIKE '%@%') AND sign_up_date > DATE '1995-12-31'"
    ),
    "dq_price_rule": _alert_sql(
        "price", "count(*)", "v_menu WHERE sale_price_usd > cost_of_goods_usd * 5 OR sale_price_usd < cost_of_goods_usd"
    ),
    "dq_duplicate_orders": _alert_sql(
        "duplicate", "CAST(sum(c - 1) AS BIGINT)",
        f"(SELECT count(*) AS c FROM v_landing WHERE {LAST_YEAR} GROUP BY customer_id, order_ts, order_total HAVING count(*) > 1)",
    ),
    "dq_future_dated": _alert_sql("future", "count(*)", "v_landing WHERE order_ts > TIMESTAMP '2001-07-01'"),
}


@query("dq_missing_values", SQL["dq_missing_values"])
def dq_missing_values(spark, sf):
    return run_rules(recent_landing(spark, sf), [missing_values(AS_OF, YEAR_HOURS)])


@query("dq_amount_anomaly", SQL["dq_amount_anomaly"])
def dq_amount_anomaly(spark, sf):
    return run_rules(recent_landing(spark, sf), [amount_anomaly(AS_OF, YEAR_HOURS)])


@query("dq_negative_total", SQL["dq_negative_total"])
def dq_negative_total(spark, sf):
    return run_rules(recent_landing(spark, sf), [negative_total(AS_OF, YEAR_HOURS)])


@query("dq_orphan_headers", SQL["dq_orphan_headers"])
def dq_orphan_headers(spark, sf, as_of: datetime = AS_OF, hours: int = YEAR_HOURS):
    start = as_of - timedelta(hours=hours)
    recent = D.order_header(spark, sf, since=start.date()).filter(_recent(as_of, hours)).select("order_id")
    lost = orphans(recent, D.order_items(spark, sf), "order_id")
    return alert_if_any(lost.agg(n_rows("record_count")), _rule("orphan"))


@query("dq_invalid_email", SQL["dq_invalid_email"])
def dq_invalid_email(spark, sf):
    return run_rules(D.customer_loyalty(spark, sf), [invalid_email(MEMBERS_AS_OF, 365)])


@query("dq_price_rule", SQL["dq_price_rule"])
def dq_price_rule(spark, sf):
    return run_rules(D.menu(spark, sf), [price_rule()])


@query("dq_duplicate_orders", SQL["dq_duplicate_orders"])
def dq_duplicate_orders(spark, sf, as_of: datetime = AS_OF, hours: int = YEAR_HOURS):
    recent = recent_landing(spark, sf, as_of, hours).filter(_recent(as_of, hours))
    return alert_if_any(excess_rows(recent, ["customer_id", "order_ts", "order_total"]), _rule("duplicate"))


@query("dq_future_dated", SQL["dq_future_dated"])
def dq_future_dated(spark, sf):
    return run_rules(recent_landing(spark, sf), [future_dated(AS_OF)])


@query(
    "dq_duplicate_keys",
    "SELECT order_id, line_number, count(*) AS cnt FROM v_items GROUP BY 1, 2 HAVING count(*) > 1",
)
def dq_duplicate_keys(spark, sf):
    return duplicates(D.order_items(spark, sf), ["order_id", "line_number"])


@query(
    "dq_orphan_items",
    "SELECT count(*) AS orphan_items FROM v_items WHERE order_id NOT IN (SELECT order_id FROM v_orders WHERE order_status <> 'PENDING')",
)
def dq_orphan_items(spark, sf):
    """Lines whose order is not among the confirmed ones."""
    confirmed = D.orders(spark, sf, status=("COMPLETED", "PROCESSING"))
    return orphans(D.order_items(spark, sf).select("order_id"), confirmed, "order_id").agg(n_rows("orphan_items"))


@query(
    "dq_negative_stock",
    f"SELECT product_id, product_name, current_stock FROM ({P.INVENTORY_SQL}) WHERE current_stock < 0",
)
def dq_negative_stock(spark, sf):
    return P.current_inventory(spark, sf).filter("current_stock < 0").select("product_id", "product_name", "current_stock")


@query(
    "dq_empty_orders",
    "SELECT order_id, strftime(order_date, '%Y-%m-%d') AS order_date, order_status FROM v_orders WHERE order_id NOT IN (SELECT order_id FROM v_items)",
)
def dq_empty_orders(spark, sf):
    return orphans(D.orders(spark, sf).select("order_id", "order_date", "order_status"), D.order_items(spark, sf), "order_id")


@query(
    "dq_date_completeness",
    """SELECT strftime(min(order_date), '%Y-%m-%d') AS first_day, strftime(max(order_date), '%Y-%m-%d') AS last_day,
  CAST(date_diff('day', min(order_date), max(order_date)) + 1 AS BIGINT) AS days, count(DISTINCT year(order_date)) AS years FROM v_orders""",
)
def dq_date_completeness(spark, sf):
    return P.dim_date(spark, sf).agg(
        F.min("date_actual").alias("first_day"),
        F.max("date_actual").alias("last_day"),
        n_rows("days"),
        F.count_distinct("year").alias("years"),
    )


@query("dq_run_all", " UNION ALL ".join(SQL.values()))
def dq_run_all(spark, sf):
    """All eight checks; rules on one source share one scan."""
    landed = recent_landing(spark, sf)
    parts = [
        run_rules(landed, header_rules(AS_OF, YEAR_HOURS)),
        run_rules(D.customer_loyalty(spark, sf), [invalid_email(MEMBERS_AS_OF, 365)]),
        run_rules(D.menu(spark, sf), [price_rule()]),
        dq_duplicate_orders(spark, sf),
        dq_orphan_headers(spark, sf),
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)
