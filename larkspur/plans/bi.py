"""Business questions over the sales datasets."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Window
from pyspark.sql import functions as F

from larkspur import domain as D
from larkspur.functions.units import round_half_up
from larkspur.plans import datasets as P
from larkspur.plans.aggregates import n_rows
from larkspur.registry import query

PERCENT_SQL = "floor(CAST(count(*) AS DOUBLE) * 100 / CAST(sum(count(*)) OVER () AS DOUBLE) * 100 + 0.5) / 100"


def percent_of_total(counts, n: str, alias: str):
    """``counts`` has a few rows, so one window over all of them reads the base once."""
    total = F.sum(n).over(Window.partitionBy())
    return counts.withColumn(alias, round_half_up(F.col(n).cast("double") * 100 / total, 2))


def completed(spark, sf, **only):
    return P.enriched_orders(spark, sf, status="COMPLETED", **only)


@query(
    "bi_top_customers",
    f"""SELECT customer_name, customer_segment, country, count(*) AS order_count, CAST(sum(total_amount) AS DOUBLE) AS total_revenue,
  CAST(sum(total_amount) AS DOUBLE) / count(total_amount) AS avg_order_value FROM ({P.ENRICHED_SQL})
WHERE order_date >= DATE '2001-07-02' AND order_status = 'COMPLETED' GROUP BY customer_id, 1, 2, 3 ORDER BY total_revenue DESC NULLS LAST, customer_name, customer_id LIMIT 10""",
)
def bi_top_customers(spark, sf, as_of: date = D.AS_OF_ORDERS, days: int = 30, k: int = 10):
    return (
        completed(spark, sf, since=as_of - timedelta(days=days))
        .groupBy("customer_id", "customer_name", "customer_segment", "country")
        .agg(
            n_rows("order_count"),
            F.sum("total_amount").alias("total_revenue"),
            F.try_divide(F.sum("total_amount").cast("double"), F.count("total_amount")).alias("avg_order_value"),
        )
        .orderBy(F.desc_nulls_last("total_revenue"), "customer_name", "customer_id")
        .limit(k)
        .drop("customer_id")
    )


@query(
    "bi_top_margin_products",
    f"""SELECT product_name, category, brand, order_count, net_revenue, profit, profit_margin_percent, CASE WHEN profit_margin_percent >= 50 THEN 'Excellent'
  WHEN profit_margin_percent >= 30 THEN 'Good' WHEN profit_margin_percent >= 15 THEN 'Fair' ELSE 'Low' END AS margin_category
FROM ({P.PERFORMANCE_SQL}) WHERE order_count > 0 ORDER BY profit_margin_percent DESC, product_name LIMIT 10""",
)
def bi_top_margin_products(spark, sf, k: int = 10):
    m = F.col("profit_margin_percent")
    band = F.when(m >= 50, "Excellent").when(m >= 30, "Good").when(m >= 15, "Fair").otherwise("Low")
    return (
        P.product_performance(spark, sf)
        .filter("order_count > 0")
        .select("product_name", "category", "brand", "order_count", "net_revenue", "profit", m, band.alias("margin_category"))
        .orderBy(F.desc("profit_margin_percent"), "product_name")
        .limit(k)
    )


@query(
    "bi_top_revenue_products",
    f"""SELECT product_name, category, total_quantity_sold, net_revenue, profit_margin_percent FROM ({P.PERFORMANCE_SQL})
ORDER BY net_revenue DESC NULLS LAST, product_name LIMIT 10""",
)
def bi_top_revenue_products(spark, sf, k: int = 10):
    return (
        P.product_performance(spark, sf)
        .select("product_name", "category", "total_quantity_sold", "net_revenue", "profit_margin_percent")
        .orderBy(F.desc_nulls_last("net_revenue"), "product_name")
        .limit(k)
    )


@query(
    "bi_category_month",
    """SELECT CAST(year(o.order_date) AS BIGINT) AS year, CAST(month(o.order_date) AS BIGINT) AS month, p.category, count(DISTINCT o.order_id) AS orders,
  CAST(sum(i.quantity) AS BIGINT) AS units_sold, CAST(sum(i.net_amount) AS DOUBLE) AS revenue
FROM v_orders o JOIN v_customers c USING (customer_id) JOIN v_items i USING (order_id) JOIN v_products p USING (product_id)
WHERE o.order_status = 'COMPLETED' GROUP BY 1, 2, 3""",
)
def bi_category_month(spark, sf):
    """Lines meet their category, then shrink to one row per order and category before the order join."""
    goods = D.products(spark, sf).select("product_id", "category")
    per_order = (
        D.line_amounts(D.order_items(spark, sf))
        .join(goods, "product_id")
        .groupBy("order_id", "category")
        .agg(F.sum("quantity").alias("q"), F.sum("net_amount").alias("n"))
    )
    heads = (
        D.orders(spark, sf, status="COMPLETED")
        .select("order_id", "customer_id", F.year("order_date").alias("year"), F.month("order_date").alias("month"))
        .join(D.customers(spark, sf).select("customer_id"), "customer_id", "left_semi")
    )
    return (
        per_order.join(heads, "order_id")
        .groupBy("year", "month", "category")
        .agg(n_rows("orders"), F.sum("q").alias("units_sold"), F.sum("n").alias("revenue"))
    )


@query(
    "bi_segment",
    f"""SELECT customer_segment, count(DISTINCT customer_id) AS customer_count, count(DISTINCT order_id) AS total_orders,
  CAST(sum(total_amount) AS DOUBLE) AS total_revenue, CAST(sum(total_amount) AS DOUBLE) / count(total_amount) AS avg_order_value,
  CAST(sum(total_amount) AS DOUBLE) / count(DISTINCT customer_id) AS revenue_per_customer
FROM ({P.ENRICHED_SQL}) WHERE order_status = 'COMPLETED' GROUP BY 1""",
)
def bi_segment(spark, sf):
    """Revenue per customer segment: one row per customer first, then one per segment."""
    per_customer = (
        completed(spark, sf)
        .groupBy("customer_segment", "customer_id")
        .agg(n_rows("orders"), F.sum("total_amount").alias("revenue"), F.count("total_amount").alias("valued"))
    )
    return (
        per_customer.groupBy("customer_segment")
        .agg(
            n_rows("customer_count"),
            F.sum("orders").alias("total_orders"),
            F.sum("revenue").alias("total_revenue"),
            F.try_divide(F.sum("revenue").cast("double"), F.sum("valued")).alias("avg_order_value"),
        )
        .withColumn("revenue_per_customer", F.col("total_revenue").cast("double") / F.col("customer_count"))
    )


@query(
    "bi_restock",
    f"""SELECT product_name, category, brand, current_stock, stock_status, total_quantity_sold, last_movement_date,
  CAST(date_diff('day', CAST(last_movement_date AS DATE), DATE '2001-08-01') AS BIGINT) AS days_since_last_movement
FROM ({P.INVENTORY_SQL}) JOIN (SELECT product_id, total_quantity_sold FROM ({P.PERFORMANCE_SQL})) USING (product_id)
WHERE stock_status IN ('LOW', 'MEDIUM') ORDER BY current_stock, total_quantity_sold DESC NULLS LAST, product_name LIMIT 20""",
)
def bi_restock(spark, sf, as_of: date = D.AS_OF_ORDERS, k: int = 20):
    sold = D.order_items(spark, sf).groupBy("product_id").agg(F.sum("quantity").alias("total_quantity_sold"))
    return (
        P.current_inventory(spark, sf)
        .filter(F.col("stock_status").isin("LOW", "MEDIUM"))
        .join(sold, "product_id", "left")
        .select(
            "product_name",
            "category",
            "brand",
            "current_stock",
            "stock_status",
            "total_quantity_sold",
            "last_movement_date",
            F.datediff(F.lit(as_of), "last_movement_date").alias("days_since_last_movement"),
        )
        .orderBy("current_stock", F.desc_nulls_last("total_quantity_sold"), "product_name")
        .limit(k)
    )


@query(
    "bi_daily_trend",
    f"""SELECT strftime(summary_date, '%Y-%m-%d') AS summary_date, total_orders, CAST(total_revenue AS DOUBLE) AS total_revenue, CAST(total_profit AS DOUBLE) AS total_profit,
  unique_customers, avg_line_value, sign(m) * floor(abs(m) * 100 + 0.5) / 100 AS profit_margin_percent FROM
(SELECT *, CAST(total_profit AS DOUBLE) / nullif(CAST(total_revenue AS DOUBLE), 0) * 100 AS m FROM ({P.DAILY_SQL})) WHERE summary_date >= DATE '2001-07-02'""",
)
def bi_daily_trend(spark, sf, as_of: date = D.AS_OF_ORDERS, days: int = 30):
    margin = F.try_divide(F.col("total_profit").cast("double"), F.col("total_revenue").cast("double")) * 100
    return (
        P.daily_sales_summary(spark, sf, since=as_of - timedelta(days=days))
        .select(
            "summary_date",
            "total_orders",
            "total_revenue",
            "total_profit",
            "unique_customers",
            "avg_line_value",
            round_half_up(margin, 2).alias("profit_margin_percent"),
        )
        .orderBy(F.desc("summary_date"))
    )


@query(
    "bi_status_share",
    f"SELECT order_status, count(*) AS order_count, {PERCENT_SQL} AS percentage, CAST(sum(total_amount) AS DOUBLE) AS total_value FROM ({P.ENRICHED_SQL}) GROUP BY 1",
)
def bi_status_share(spark, sf):
    counts = P.enriched_orders(spark, sf).groupBy("order_status").agg(n_rows("order_count"), F.sum("total_amount").alias("total_value"))
    return percent_of_total(counts, "order_count", "percentage")


@query(
    "bi_payment_share",
    f"""SELECT payment_method, count(*) AS transaction_count, {PERCENT_SQL} AS usage_percent, CAST(sum(total_amount) AS DOUBLE) AS total_processed,
  CAST(sum(total_amount) AS DOUBLE) / count(total_amount) AS avg_transaction_value FROM ({P.ENRICHED_SQL}) WHERE order_status = 'COMPLETED' GROUP BY 1""",
)
def bi_payment_share(spark, sf):
    counts = (
        completed(spark, sf)
        .groupBy("payment_method")
        .agg(
            n_rows("transaction_count"),
            F.sum("total_amount").alias("total_processed"),
            F.try_divide(F.sum("total_amount").cast("double"), F.count("total_amount")).alias("avg_transaction_value"),
        )
    )
    return percent_of_total(counts, "transaction_count", "usage_percent")


@query(
    "bi_geography",
    f"""SELECT country, count(DISTINCT customer_id) AS customers, count(DISTINCT order_id) AS orders, CAST(sum(total_amount) AS DOUBLE) AS revenue,
  CAST(sum(total_amount) AS DOUBLE) / count(total_amount) AS avg_order_value FROM ({P.ENRICHED_SQL}) WHERE order_status = 'COMPLETED' GROUP BY 1""",
)
def bi_geography(spark, sf):
    per_customer = (
        completed(spark, sf)
        .groupBy("country", "customer_id")
        .agg(n_rows("orders"), F.sum("total_amount").alias("revenue"), F.count("total_amount").alias("valued"))
    )
    return per_customer.groupBy("country").agg(
        n_rows("customers"),
        F.sum("orders").alias("orders"),
        F.sum("revenue").alias("revenue"),
        F.try_divide(F.sum("revenue").cast("double"), F.sum("valued")).alias("avg_order_value"),
    )


@query(
    "bi_stockout_days",
    f"""SELECT product_id, product_name, current_stock, sold / 365 AS daily_sales, CASE WHEN sold > 0 THEN current_stock / (sold / 365) END AS days_until_stockout
FROM ({P.INVENTORY_SQL}) LEFT JOIN (SELECT product_id, CAST(sum(quantity) AS DOUBLE) AS sold FROM v_movements WHERE movement_type = 'SALE'
  AND movement_date > DATE '2000-08-01' AND movement_date <= DATE '2001-08-01' GROUP BY 1) USING (product_id) WHERE current_stock > 0""",
)
def bi_stockout_days(spark, sf, as_of: date = D.AS_OF_ORDERS, days: int = 365):
    """Stock on hand divided by the sales rate of the last year."""
    rate = (
        D.inventory_movements(spark, sf, as_of - timedelta(days=days - 1), as_of)
        .filter(F.col("movement_type") == "SALE")
        .groupBy("product_id")
        .agg((F.sum("quantity").cast("double") / days).alias("daily_sales"))
    )
    return (
        P.current_inventory(spark, sf)
        .filter("current_stock > 0")
        .join(rate, "product_id", "left")
        .select(
            "product_id",
            "product_name",
            "current_stock",
            "daily_sales",
            F.try_divide(F.col("current_stock").cast("double"), F.col("daily_sales")).alias("days_until_stockout"),
        )
    )


@query(
    "bi_load_summary",
    """SELECT count(*) AS total_rows, count(DISTINCT order_id) AS unique_orders, strftime(min(order_ts), '%Y-%m-%d %H:%M:%S') AS earliest,
  strftime(max(order_ts), '%Y-%m-%d %H:%M:%S') AS latest, CAST(sum(order_total) AS DOUBLE) AS total_revenue FROM v_landing""",
)
def bi_load_summary(spark, sf):
    return D.landing_header(spark, sf).agg(
        n_rows("total_rows"),
        F.count_distinct("order_id").alias("unique_orders"),
        F.min("order_ts").alias("earliest"),
        F.max("order_ts").alias("latest"),
        F.sum("order_total").alias("total_revenue"),
    )


@query("bi_unique_cities", "SELECT DISTINCT city FROM v_customers ORDER BY 1")
def bi_unique_cities(spark, sf):
    return D.customers(spark, sf).select("city").distinct().orderBy("city")


@query(
    "bi_menu_max_price",
    """SELECT menu_item_id, menu_item_name, CAST(sale_price_usd AS DOUBLE) AS price, CAST((SELECT max(sale_price_usd) FROM v_menu) AS DOUBLE) AS max_price
FROM v_menu WHERE sale_price_usd > 950 AND menu_item_name ILIKE '%ring%'""",
)
def bi_menu_max_price(spark, sf, floor: int = 950, like: str = "%ring%"):
    menu = D.menu(spark, sf).select("menu_item_id", "menu_item_name", F.col("sale_price_usd").alias("price"))
    top = menu.agg(F.max("price")).scalar()
    return menu.filter((F.col("price") > floor) & F.col("menu_item_name").ilike(like)).withColumn("max_price", top)
