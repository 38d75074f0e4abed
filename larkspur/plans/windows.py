"""Window results, sorts, limits and stacked unions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from larkspur import domain as D
from larkspur.operators import ordered
from larkspur.plans.aggregates import n_rows
from larkspur.registry import query


def _spend(spark, sf):
    return D.table(spark, sf, "orders").select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderkey").alias("order_id"),
        F.to_date("o_orderdate").alias("order_date"),
        D.dec("o_totalprice").alias("total"),
    )


SPEND_SQL = """SELECT o_custkey AS customer_id, o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS order_date,
CAST(o_totalprice AS DECIMAL(18,4)) AS total FROM orders"""


@query(
    "win_row_number_key",
    "SELECT order_item_id, 15000 + row_number() OVER (ORDER BY order_id, order_item_id) AS line_key FROM v_items",
)
def win_row_number_key(spark, sf):
    lines = D.order_items(spark, sf).select("order_id", "order_item_id")
    return ordered.numbered(lines, ["order_id", "order_item_id"], "line_key", start=15001).drop("order_id")


@query(
    "win_share_of_total",
    """SELECT order_status, payment_method, count(*) AS n, CAST(count(*) AS DOUBLE) * 100 / CAST(sum(count(*)) OVER () AS DOUBLE) AS share
FROM v_orders GROUP BY 1, 2""",
)
def win_share_of_total(spark, sf):
    return share_of_total(D.orders(spark, sf).groupBy("order_status", "payment_method").agg(n_rows()))


def share_of_total(counts, n="n", alias="share"):
    """Percent of the grand total of a few counted groups, over which one window runs; the base is read once."""
    total = F.sum(n).over(Window.partitionBy())
    return counts.withColumn(alias, F.col(n).cast("double") * 100 / total)


@query(
    "win_ranking",
    f"""SELECT order_id, row_number() OVER w AS row_number, rank() OVER w AS rank, dense_rank() OVER w AS dense_rank, percent_rank() OVER w AS percent_rank,
  cume_dist() OVER w AS cume_dist, ntile(4) OVER (PARTITION BY customer_id ORDER BY total DESC, order_id) AS ntile FROM ({SPEND_SQL})
WINDOW w AS (PARTITION BY customer_id ORDER BY total DESC, order_id)""",
)
def win_ranking(spark, sf):
    ranked = ordered.ranks(_spend(spark, sf), ["customer_id"], [F.desc("total"), "order_id"])
    return ranked.select("order_id", "row_number", "rank", "dense_rank", "percent_rank", "cume_dist", "ntile")


@query(
    "win_offset",
    f"""SELECT order_id, CAST(lag(total, 1) OVER w AS DOUBLE) AS lag_value, CAST(lead(total, 1) OVER w AS DOUBLE) AS lead_value,
  CAST(lag(total, 2, 0) OVER w AS DOUBLE) AS lag_2, CAST(lead(total, 2, 0) OVER w AS DOUBLE) AS lead_2 FROM ({SPEND_SQL})
WINDOW w AS (PARTITION BY customer_id ORDER BY order_date, order_id)""",
)
def win_offset(spark, sf):
    wanted = {"lag_value": (1, None), "lead_value": (-1, None), "lag_2": (2, 0), "lead_2": (-2, 0)}
    rows = ordered.neighbours(_spend(spark, sf), ["customer_id"], ["order_date", "order_id"], "total", wanted)
    return rows.select("order_id", *wanted)


@query(
    "win_value",
    f"""SELECT order_id, CAST(first_value(total) OVER w AS DOUBLE) AS first_total, CAST(last_value(total) OVER w AS DOUBLE) AS last_total,
  CAST(nth_value(total, 2) OVER w AS DOUBLE) AS second_total FROM ({SPEND_SQL}) WINDOW w AS
(PARTITION BY customer_id ORDER BY order_date, order_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""",
)
def win_value(spark, sf):
    """First, last and second value of the whole group: aggregates per key, joined back."""
    rows = _spend(spark, sf)
    place = F.struct("order_date", "order_id")
    ends = rows.groupBy("customer_id").agg(
        F.min(F.struct(place.alias("p"), "total")).alias("a"),
        F.max(F.struct(place.alias("p"), "total")).alias("z"),
    )
    # the second value is the first one after the group's minimum
    later = (
        rows.join(ends.select("customer_id", F.col("a.p").alias("first_place")), "customer_id")
        .filter(place > F.col("first_place"))
        .groupBy("customer_id")
        .agg(F.min(F.struct(place.alias("p"), "total"))["total"].alias("second_total"))
    )
    values = ends.join(later, "customer_id", "left").select(
        "customer_id",
        F.col("a.total").alias("first_total"),
        F.col("z.total").alias("last_total"),
        "second_total",
    )
    return rows.join(values, "customer_id").select("order_id", "first_total", "last_total", "second_total")


@query(
    "win_running",
    f"""SELECT order_id, CAST(sum(total) OVER w AS DOUBLE) AS running_sum, CAST(sum(total) OVER w AS DOUBLE) / count(total) OVER w AS running_avg,
  count(total) OVER w AS running_count, CAST(min(total) OVER w AS DOUBLE) AS running_min, CAST(max(total) OVER w AS DOUBLE) AS running_max
FROM ({SPEND_SQL}) WINDOW w AS (PARTITION BY customer_id ORDER BY order_date)""",
)
def win_running(spark, sf):
    return ordered.running(_spend(spark, sf), ["customer_id"], ["order_date"], "total").select(
        "order_id", "running_sum", "running_avg", "running_count", "running_min", "running_max"
    )


@query(
    "win_ratio_to_report",
    f"SELECT order_id, CAST(total AS DOUBLE) / nullif(CAST(sum(total) OVER (PARTITION BY customer_id) AS DOUBLE), 0) AS ratio FROM ({SPEND_SQL})",
)
def win_ratio_to_report(spark, sf):
    rows = _spend(spark, sf)
    sums = rows.groupBy("customer_id").agg(F.sum("total").cast("double").alias("s"))
    return rows.join(sums, "customer_id").select(
        "order_id", F.try_divide(F.col("total").cast("double"), F.col("s")).alias("ratio")
    )


@query(
    "topk",
    "SELECT order_id, CAST(order_total AS DOUBLE) AS order_total FROM v_header ORDER BY order_total DESC, order_id LIMIT 10",
)
def topk(spark, sf, k: int = 10):
    return D.order_header(spark, sf).select("order_id", "order_total").orderBy(F.desc("order_total"), "order_id").limit(k)


@query(
    "sort_multi",
    "SELECT customer_segment, country, count(*) AS n FROM v_customers GROUP BY 1, 2 ORDER BY n DESC, country, customer_segment",
)
def sort_multi(spark, sf):
    return (
        D.customers(spark, sf)
        .groupBy("customer_segment", "country")
        .agg(n_rows())
        .orderBy(F.desc("n"), "country", "customer_segment")
    )


# Order of the alert levels.
LEVELS = {"CRITICAL": 1, "ERROR": 2, "WARNING": 3}


def severity_rank(col="severity"):
    return D.lookup(F.col(col), LEVELS, 4)


@query("sort_custom_rank", "SELECT severity, count(*) AS n FROM v_alerts GROUP BY 1")
def sort_custom_rank(spark, sf):
    return D.alerts(spark, sf).groupBy("severity").agg(n_rows()).orderBy(severity_rank())


@query(
    "sort_ordinal",
    "SELECT menu_item_name, CAST(max(sale_price_usd) AS DOUBLE) AS price FROM v_menu GROUP BY 1 ORDER BY 2 DESC, 1",
)
def sort_ordinal(spark, sf):
    return spark.sql(
        "SELECT menu_item_name, max(sale_price_usd) AS price FROM {menu} GROUP BY 1 ORDER BY 2 DESC, 1",
        menu=D.menu(spark, sf),
    )


@query("limit_any", "SELECT order_id FROM v_orders ORDER BY order_date, order_id LIMIT 1000")
def limit_any(spark, sf, n: int = 1000):
    return D.orders(spark, sf).select("order_id", "order_date").orderBy("order_date", "order_id").limit(n).select("order_id")


@query(
    "union_all",
    """SELECT 'orders' AS stream, order_status AS kind, count(*) AS pending, CAST(NULL AS VARCHAR) AS note FROM v_orders GROUP BY 2
UNION ALL SELECT 'movements', movement_type, count(*), NULL FROM v_movements GROUP BY 2
UNION ALL SELECT 'changes', action, count(*), 'log' FROM v_changes GROUP BY 2""",
)
def union_all(spark, sf):
    def counts(df, name, col):
        return df.groupBy(F.col(col).alias("kind")).agg(n_rows("pending")).select(F.lit(name).alias("stream"), "kind", "pending")

    parts = [
        counts(D.change_log(spark, sf), "changes", "action").withColumn("note", F.lit("log")),
        counts(D.orders(spark, sf), "orders", "order_status"),
        counts(D.inventory_movements(spark, sf), "movements", "movement_type"),
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
