"""Projections and filters: each is one narrow stage over a pruned scan."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from larkspur import domain as D
from larkspur.functions.units import round_half_up
from larkspur.registry import query


@query(
    "project_arith",
    """SELECT order_item_id, CAST(subtotal AS DOUBLE) AS subtotal, CAST(line_discount AS DOUBLE) AS line_discount,
  CAST(net_amount AS DOUBLE) AS net_amount, CAST(quantity * cost_price AS DOUBLE) AS cost_amount,
  CAST(net_amount - quantity * cost_price AS DOUBLE) AS profit_amount, CAST(quantity * 2 AS BIGINT) AS doubled
FROM v_items JOIN v_products USING (product_id)""",
)
def project_arith(spark, sf):
    items = D.line_amounts(D.order_items(spark, sf))
    costs = D.products(spark, sf).select("product_id", "cost_price")
    cost = D.dec(F.col("quantity").cast("decimal(4,0)") * F.col("cost_price"))
    return (
        items.join(costs, "product_id")
        .withColumn("cost_amount", cost)
        .select(
            "order_item_id",
            "subtotal",
            "line_discount",
            "net_amount",
            "cost_amount",
            (F.col("net_amount") - F.col("cost_amount")).alias("profit_amount"),
            (F.col("quantity") * 2).alias("doubled"),
        )
    )


@query(
    "project_star_plus",
    """SELECT strftime(CAST(order_ts AS DATE), '%Y-%m-%d') AS date, order_id, truck_id, location_id, customer_id,
  strftime(order_ts, '%Y-%m-%d %H:%M:%S') AS order_ts, CAST(order_amount AS DOUBLE) AS order_amount, order_tax_amount,
  order_discount_amount, CAST(order_total AS DOUBLE) AS order_total FROM v_header""",
)
def project_star_plus(spark, sf):
    return D.order_header(spark, sf).select(F.to_date("order_ts").alias("date"), "*")


@query(
    "case_bucket",
    """SELECT product_id, CAST(unit_price - cost_price AS DOUBLE) AS margin,
  CASE WHEN unit_price >= cost_price * 1.50 THEN 'High' WHEN unit_price >= cost_price * 1.30 THEN 'Medium'
    WHEN unit_price >= cost_price * 1.15 THEN 'Low' ELSE 'Very low' END AS margin_band,
  CASE WHEN stock_quantity < 10 THEN 'LOW' WHEN stock_quantity < 50 THEN 'MEDIUM' ELSE 'HEALTHY' END AS stock_status
FROM v_products""",
)
def case_bucket(spark, sf):
    price, cost = F.col("unit_price"), F.col("cost_price")
    return D.products(spark, sf).select(
        "product_id",
        (price - cost).alias("margin"),
        F.when(price >= cost * F.expr("1.50"), "High")
        .when(price >= cost * F.expr("1.30"), "Medium")
        .when(price >= cost * F.expr("1.15"), "Low")
        .otherwise("Very low")
        .alias("margin_band"),
        stock_status(F.col("stock_quantity")).alias("stock_status"),
    )


def stock_status(stock):
    return F.when(stock < 10, "LOW").when(stock < 50, "MEDIUM").otherwise("HEALTHY")


@query(
    "case_decode",
    """SELECT o_orderkey AS order_id, CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'PROCESSING' ELSE 'PENDING' END
  AS order_status, CAST(left(o_orderpriority, 1) AS BIGINT) AS severity_rank, CASE WHEN o_orderkey % 50 = 0 THEN 'guest' ELSE 'member' END AS buyer
FROM orders""",
)
def case_decode(spark, sf):
    ranks = {name: i for i, name in enumerate(sorted(D.PAYMENT_METHODS), start=1)}
    member = F.when(F.col("o_orderkey") % 50 != 0, F.col("o_custkey"))
    return D.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        D.renamed(F.col("o_orderstatus"), D.ORDER_STATUS).alias("order_status"),
        D.lookup(F.col("o_orderpriority"), ranks).alias("severity_rank"),
        # decode() pairs NULL with NULL, unlike a simple CASE
        F.when(member.eqNullSafe(F.lit(None)), "guest").otherwise("member").alias("buyer"),
    )


@query(
    "format_count",
    """WITH c AS (SELECT order_status, CAST(sum(CAST(floor(o_totalprice) AS BIGINT)) AS BIGINT) AS amount, count(*) AS n
  FROM v_orders JOIN orders ON order_id = o_orderkey GROUP BY 1),
u AS (SELECT *, CASE WHEN amount >= 1000000000 THEN 1000000000 WHEN amount >= 1000000 THEN 1000000 WHEN amount >= 1000 THEN 1000 END AS unit FROM c)
SELECT order_status, n, CASE WHEN unit IS NULL THEN CAST(amount AS VARCHAR) ELSE
  ((amount * 10 + unit // 2) // unit) // 10 || '.' || ((amount * 10 + unit // 2) // unit) % 10 ||
  CASE unit WHEN 1000000000 THEN 'B' WHEN 1000000 THEN 'M' ELSE 'K' END END AS formatted FROM u""",
)
def format_count(spark, sf):
    return (
        D.table(spark, sf, "orders")
        .groupBy(D.renamed(F.col("o_orderstatus"), D.ORDER_STATUS).alias("order_status"))
        .agg(F.sum(F.floor("o_totalprice")).alias("amount"), F.count(F.lit(1)).alias("n"))
        .select("order_status", "n", human_count(F.col("amount")).alias("formatted"))
    )


def human_count(n):
    """1234567 -> 1.2M"""

    def scaled(unit: int, suffix: str):
        return F.concat(F.round(n.cast("decimal(20,0)") / F.lit(unit), 1).cast("decimal(20,1)").cast("string"), F.lit(suffix))

    return (
        F.when(n >= 10**9, scaled(10**9, "B"))
        .when(n >= 10**6, scaled(10**6, "M"))
        .when(n >= 10**3, scaled(10**3, "K"))
        .otherwise(n.cast("string"))
    )


@query(
    "format_bytes",
    """WITH b AS (SELECT source, CAST(sum(n_chars) * 1024 AS BIGINT) AS bytes FROM documents GROUP BY 1)
SELECT source, bytes, CASE WHEN bytes > 536870912 THEN floor(bytes / 1073741824 * 100 + 0.5) / 100 ELSE floor(bytes / 1048576 * 100 + 0.5) / 100 END AS size_value,
  CASE WHEN bytes > 536870912 THEN 'GB' ELSE 'MB' END AS size_unit FROM b""",
)
def format_bytes(spark, sf):
    b = F.col("bytes")
    big = b > 512 * 2**20
    return (
        D.table(spark, sf, "documents")
        .groupBy("source")
        .agg((F.sum("n_chars") * 1024).alias("bytes"))
        .select(
            "source",
            "bytes",
            round_half_up(F.when(big, b / F.lit(2**30)).otherwise(b / F.lit(2**20)), 2).alias("size_value"),
            F.when(big, "GB").otherwise("MB").alias("size_unit"),
        )
    )


@query(
    "date_key",
    "SELECT order_id, CAST(strftime(order_date, '%Y%m%d') AS BIGINT) AS date_sk FROM v_orders",
)
def date_key_query(spark, sf):
    return D.orders(spark, sf).select("order_id", date_key("order_date").alias("date_sk"))


def date_key(col):
    """yyyymmdd as integer arithmetic, cheaper than formatting and parsing text."""
    return (F.year(col) * 10000 + F.month(col) * 100 + F.day(col)).cast("int")


@query(
    "string_build",
    """SELECT customer_id, customer_name || ' #' || customer_id AS label, 'Mr/Ms ' || e_mail AS greeting,
  concat_ws('; ', nullif(e_mail, ''), phone_number) AS contacts FROM v_customers c JOIN
  (SELECT customer_id, e_mail, phone_number FROM v_loyalty) USING (customer_id)""",
)
def string_build(spark, sf):
    return D.customer_loyalty(spark, sf).select(
        "customer_id",
        F.concat("first_name", F.lit(" #"), D.text_id("customer_id")).alias("label"),
        F.concat(F.lit("Mr/Ms "), F.col("e_mail")).alias("greeting"),
        F.concat_ws("; ", F.nullif(F.col("e_mail"), F.lit("")), "phone_number").alias("contacts"),
    )


@query(
    "filter_conj",
    """SELECT order_id, customer_id, strftime(order_date, '%Y-%m-%d') AS order_date FROM v_orders
WHERE order_status = 'COMPLETED' AND payment_method = 'PayPal' AND year(order_date) = 1997 AND month(order_date) = 2""",
)
def filter_conj(spark, sf):
    # the raw columns are filtered, and the month is a range, so all conjuncts reach the scan
    raw = D.table(spark, sf, "orders").filter(
        (F.col("o_orderstatus") == "F")
        & (F.col("o_orderpriority") == "2-HIGH")
        & (F.col("o_orderdate") >= F.lit("1997-02-01").cast("timestamp_ntz"))
        & (F.col("o_orderdate") < F.lit("1997-03-01").cast("timestamp_ntz"))
    )
    return raw.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.to_date("o_orderdate").alias("order_date"),
    )


@query(
    "filter_in_between",
    """SELECT product_id, brand, category, CAST(unit_price AS DOUBLE) AS unit_price FROM v_products
WHERE category IN ('ECONOMY', 'PROMO') AND unit_price BETWEEN 920 AND 960""",
)
def filter_in_between(spark, sf):
    return (
        D.products(spark, sf)
        .filter(F.col("category").isin("ECONOMY", "PROMO") & F.col("unit_price").between(920, 960))
        .select("product_id", "brand", "category", "unit_price")
    )


@query(
    "filter_like",
    """SELECT p_partkey AS product_id, p_name AS product_name FROM part
WHERE p_name LIKE 'red%' OR (p_name ILIKE '%WIDGET' AND p_name NOT LIKE '%small%')""",
)
def filter_like(spark, sf):
    name = F.col("p_name")
    return (
        D.table(spark, sf, "part")
        .filter(name.like("red%") | (name.ilike("%WIDGET") & ~name.like("%small%")))
        .select(F.col("p_partkey").alias("product_id"), name.alias("product_name"))
    )


@query(
    "filter_null_or",
    """SELECT order_id, customer_id, CAST(order_amount AS DOUBLE) AS order_amount FROM v_landing
WHERE order_total > 1500 AND (customer_id IS NULL OR order_amount IS NULL)""",
)
def filter_null_or(spark, sf):
    return (
        D.landing_header(spark, sf)
        .filter((F.col("order_total") > 1500) & (F.col("customer_id").isNull() | F.col("order_amount").isNull()))
        .select("order_id", "customer_id", "order_amount")
    )


@query(
    "filter_recent",
    """SELECT event_id, CASE WHEN ts > TIMESTAMP '2024-01-31' THEN 'future' ELSE 'recent' END AS age FROM events
WHERE ts > TIMESTAMP '2024-01-31' - INTERVAL 72 HOUR""",
)
def filter_recent(spark, sf, as_of=D.AS_OF_EVENTS, hours: int = 72):
    ts = F.col("ts")
    return (
        D.table(spark, sf, "events")
        .filter(ts > F.lit(as_of - timedelta(hours=hours)).cast("timestamp_ntz"))
        .select("event_id", F.when(ts > F.lit(as_of).cast("timestamp_ntz"), "future").otherwise("recent").alias("age"))
    )


@query(
    "filter_variant_kind",
    "SELECT event_id, CAST(regexp_extract(props, '(\\d+)', 1) AS BIGINT) AS k FROM events WHERE json_type(props) = 'OBJECT'",
)
def filter_variant_kind(spark, sf):
    return (
        D.table(spark, sf, "events")
        .withColumn("v", F.try_parse_json("props"))
        .filter(F.schema_of_variant("v").like("OBJECT%"))
        .select("event_id", F.try_variant_get("v", "$.k", "bigint").alias("k"))
    )


@query(
    "filter_params",
    """SELECT payment_method, count(*) AS orders FROM v_orders WHERE order_status = 'PENDING'
AND order_date >= DATE '1999-01-01' GROUP BY 1""",
)
def filter_params(spark, sf, status: str = "P", since: str = "1999-01-01"):
    """Bound parameters, never text pasted into a statement; both reach the scan."""
    counts = spark.sql(
        """SELECT o_orderpriority, count(*) AS orders FROM {raw}
        WHERE o_orderstatus = :status AND o_orderdate >= CAST(:since AS TIMESTAMP_NTZ) GROUP BY o_orderpriority""",
        args={"status": status, "since": since},
        raw=D.table(spark, sf, "orders"),
    )
    return counts.select(D.renamed(F.col("o_orderpriority"), D.PAYMENT_METHODS).alias("payment_method"), "orders")


@query(
    "scalar_subquery",
    """SELECT order_status, count(*) AS n, CAST(sum(order_total) AS DOUBLE) AS total FROM v_orders
JOIN v_header USING (order_id) WHERE order_total > (SELECT sum(order_total) / count(*) FROM v_header) GROUP BY 1""",
)
def scalar_subquery(spark, sf):
    raw = D.table(spark, sf, "orders").select("o_orderstatus", D.dec("o_totalprice").alias("total"))
    average = raw.agg(D.mean("total")).scalar()
    return (
        raw.filter(F.col("total") > average)
        .groupBy(D.renamed(F.col("o_orderstatus"), D.ORDER_STATUS).alias("order_status"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum("total").alias("total"))
    )
