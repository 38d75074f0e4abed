"""Aggregates that batch jobs and streaming refreshes share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def summarise_sales(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Daily totals of a sales fact table.

    Lines are first reduced to one row per order, which makes the order count a plain
    count. ``avg_line_value`` is the mean per line, not per order.
    """
    return summarise_orders(per_order(fact), dates)


def per_order(fact: DataFrame) -> DataFrame:
    """One row per order, day and buyer; these rows add up, whatever lines came when."""
    return line_sums(fact, "date_sk", "order_id", "customer_sk")


def line_sums(rows: DataFrame, *keys: str) -> DataFrame:
    """What the lines of a key add up to."""
    return rows.groupBy(*keys).agg(
        F.sum("net_amount").alias("net"),
        F.sum("profit_amount").alias("profit"),
        F.sum("quantity").alias("quantity"),
        F.count("net_amount").alias("lines"),
    )


def summarise_orders(orders: DataFrame, dates: DataFrame) -> DataFrame:
    """Daily totals of one row per order."""
    per_day = orders.groupBy("date_sk").agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.sum("net").alias("total_revenue"),
        F.sum("profit").alias("total_profit"),
        F.sum("quantity").alias("total_quantity"),
        F.count_distinct("customer_sk").alias("unique_customers"),
        (F.sum("net").cast("double") / F.sum("lines")).alias("avg_line_value"),
    )
    return per_day.join(dates.select("date_sk", F.col("date_actual").alias("summary_date")), "date_sk").drop("date_sk")
