"""Streaming jobs over the given tables, run until nothing is pending."""

from __future__ import annotations

from pyspark.sql import functions as F

from larkspur import domain as D
from larkspur.operators.refresh import line_sums, summarise_orders
from larkspur.plans import datasets as P
from larkspur.plans.aggregates import n_rows
from larkspur.registry import query, sql_of
from larkspur.streaming.consume import Consumer, append_stream, daily_parts, daily_totals, is_folder, lookback_parts, lookback_totals, once, stream_table
from larkspur.streaming.partials import PartialTable


def follow(spark, sf, name: str):
    """One of the given tables as a stream of its files; a table is one file or a folder of part files."""
    schema, path = D.table(spark, sf, name).schema, f"{sf}/{name}.parquet"
    if is_folder(spark, path):
        return stream_table(spark, path, schema)
    return stream_table(spark, sf, schema, pattern=f"{name}.parquet")


def city_totals(spark, sf, city: str):
    """Batch function: daily order totals of one city, cast to a date before they are written."""

    def transform(batch):
        place = D.location(spark, sf).filter(F.col("city") == city).select("location_id")
        return (
            D.order_header(spark, sf, raw=batch)
            .withColumn("location_id", F.col("location_id").cast("bigint"))
            .join(place, "location_id")
            .groupBy(F.to_date("order_ts").alias("date"))
            .agg(F.coalesce(F.sum("order_total"), F.lit(0)).alias("total_sales"))
        )

    return transform


CITY_TOTAL_SQL = """SELECT strftime(CAST(order_ts AS DATE), '%Y-%m-%d') AS date, CAST(sum(order_total) AS DOUBLE) AS total_sales
FROM v_header h JOIN v_location l ON CAST(h.location_id AS BIGINT) = l.location_id WHERE city = 'CITY_3' GROUP BY 1"""


@query("city_sales_incremental", CITY_TOTAL_SQL)
def city_sales_incremental(spark, sf, city: str = P.CITY):
    """Each batch appends its own totals; the reader adds the batches up."""
    consumer = Consumer.scratch(spark, "city-sales")
    consumer.run(follow(spark, sf, "orders"), city_totals(spark, sf, city))
    return consumer.result().groupBy("date").agg(F.sum("total_sales").alias("total_sales"))


@query("city_sales_live", CITY_TOTAL_SQL)
def city_sales_live(spark, sf, city: str = P.CITY):
    """The same totals kept as partial sums per day; a batch reads no order but its own."""
    place = D.location(spark, sf).filter(F.col("city") == city).select("location_id")

    def partial(batch):
        header = D.order_header(spark, sf, raw=batch).withColumn("location_id", F.col("location_id").cast("bigint"))
        day, total = F.to_date("order_ts").alias("date"), F.coalesce("order_total", F.lit(0)).cast("decimal(28,4)").alias("total_sales")
        return header.join(place, "location_id").select(day, total, one())

    table = PartialTable.scratch(spark, "city-live", ["date"], ["total_sales", "n"])
    table.refresh(follow(spark, sf, "orders"), partial)
    return table.read().drop("n")


def one():
    return F.lit(1).cast("bigint").alias("n")


@query(
    "consume_changes_once",
    """SELECT origin, count(*) AS inserts, CAST(sum(payload) AS BIGINT) AS payload FROM v_changes WHERE action = 'INSERT' GROUP BY 1""",
)
def consume_changes_once(spark, sf):
    """Two runs on one checkpoint: the second finds nothing, so totals count every change once."""
    consumer = Consumer.scratch(spark, "changes")

    def inserts(batch):
        return (
            batch.filter(F.col("event_type") != "error")
            .groupBy(F.col("event_type").alias("origin"))
            .agg(n_rows("inserts"), F.sum(D.payload()).alias("payload"))
        )

    for _ in range(2):
        consumer.run(follow(spark, sf, "events"), inserts)
    return consumer.result().groupBy("origin").agg(F.sum("inserts").alias("inserts"), F.sum("payload").alias("payload"))


def order_lines(lines: PartialTable, heads: PartialTable, keys: list[str]):
    """Rows of lines and of their orders as both have arrived, in any order: each pair counts once, and no table is read but as a stream.

    ``lines`` are stored by order, ``heads`` by order and ``keys`` with ``n``, the copies of it; what
    lines add up counts once for each copy.
    """
    copies = heads.read().select("order_id", *keys, F.col("n").alias("_copies"))
    pairs = lines.read().join(copies, "order_id")
    times = {c: F.when(F.col("_copies") == 1, F.col(c)).otherwise(F.col(c) * F.col("_copies")).cast(pairs.schema[c].dataType) for c in lines.adds}
    return pairs.withColumns(times).drop("_copies")


@query("dynamic_table_refresh", P.DAILY_PLAIN_SQL)
def dynamic_table_refresh(spark, sf):
    """Daily sales summary kept current from arriving orders and lines; its state is one narrow row per order and one for its lines."""
    lines = PartialTable.scratch(spark, "daily-lines", ["order_id"], ["net", "profit", "quantity", "lines"])
    lines.count = "lines"
    heads = PartialTable.scratch(spark, "daily-orders", ["order_id", "date_sk", "customer_sk"], ["n"])

    def sold(batch):
        rows = P.fact_amounts(P.costed(D.line_rows(spark, sf, raw=batch), P.initial_product_dim(spark, sf)))
        return line_sums(rows, "order_id")

    def placed(batch):
        rows = P.sold_by(D.orders(spark, sf, raw=batch), P.initial_customer_dim(spark, sf))
        return rows.select("order_id", P.date_key("order_date").alias("date_sk"), "customer_sk", one())

    lines.refresh(follow(spark, sf, "lineitem"), sold)
    heads.refresh(follow(spark, sf, "orders"), placed)
    return summarise_orders(order_lines(lines, heads, ["date_sk", "customer_sk"]), P.dim_date(spark, sf))


@query("brand_sales_live", sql_of("daily_sales_by_brand"))
def brand_sales_live(spark, sf):
    measures = ["order_total", "order_tax_amount", "order_discount_amount"]
    table = PartialTable.scratch(spark, "brand-live", [*P.BRAND_KEYS, "customer_id"], [*measures, "n"])

    def partial(batch):
        rows = P.brand_rows(D.order_header(spark, sf, raw=batch), D.truck(spark, sf), D.menu(spark, sf))
        return rows.select(*P.BRAND_KEYS, "customer_id", *[F.col(m).cast("decimal(28,4)").alias(m) for m in measures], one())

    table.refresh(follow(spark, sf, "orders"), partial)
    return table.read().groupBy(*P.BRAND_KEYS).agg(
        F.sum("n").alias("total_orders"),
        F.sum("order_total").alias("total_revenue"),
        F.sum("order_tax_amount").alias("total_tax"),
        F.sum("order_discount_amount").alias("total_discount"),
        F.count_distinct("customer_id").alias("unique_customers"),
        (F.sum("order_total").cast("double") / F.sum("n")).alias("avg_order_value"),
    )


@query("regional_sales_live", sql_of("regional_sales"))
def regional_sales_live(spark, sf):
    table = PartialTable.scratch(spark, "region-live", [*P.REGION_KEYS, "customer_id", "truck_id"], ["order_total", "n"])

    def partial(batch):
        rows = P.regional_rows(spark, sf, D.order_header(spark, sf, raw=batch))
        return rows.select(*P.REGION_KEYS, "customer_id", "truck_id", F.col("order_total").cast("decimal(28,4)").alias("order_total"), one())

    table.refresh(follow(spark, sf, "orders"), partial)
    return table.read().groupBy(*P.REGION_KEYS).agg(
        F.sum("n").alias("order_count"),
        F.sum("order_total").alias("total_revenue"),
        F.count_distinct("customer_id").alias("unique_customers"),
        F.count_distinct("truck_id").alias("unique_trucks"),
        (F.sum("order_total").cast("double") / F.sum("n")).alias("avg_order_value"),
    )


@query("customer_activity_live", sql_of("customer_activity"))
def customer_activity_live(spark, sf):
    """Tables of partial rows: places and totals from the orders, items from lines that meet their orders."""
    who = ["customer_id", "activity_date"]
    places = PartialTable.scratch(spark, "customer-live", [*who, "location_id"], ["total_spent", "n"], ["order_ts"])
    heads = PartialTable.scratch(spark, "customer-orders", ["order_id", *who], ["n"])
    items = PartialTable.scratch(spark, "customer-items", ["order_id", "menu_item_id"], ["n"])

    def visited(batch):
        rows = P.visits(D.order_header(spark, sf, raw=batch))
        return rows.select(*who, "location_id", F.col("total_spent").cast("decimal(28,4)").alias("total_spent"), "order_ts", one())

    places.refresh(follow(spark, sf, "orders"), visited)
    heads.refresh(follow(spark, sf, "orders"), lambda batch: P.buyers(D.order_header(spark, sf, raw=batch)).select("order_id", *who, one()))
    items.refresh(follow(spark, sf, "lineitem"), lambda batch: D.order_detail(spark, sf, raw=batch).select("order_id", "menu_item_id", one()))
    totals = places.read().groupBy(*who).agg(
        F.sum("n").alias("order_count"),
        F.sum("total_spent").alias("total_spent"),
        F.sort_array(F.collect_set("location_id")).alias("visited_locations"),
        F.max("order_ts").alias("last_order_timestamp"),
    )
    return P.with_favorites(totals, order_lines(items, heads, who).select(*who, "menu_item_id"), D.menu(spark, sf))


@query("menu_item_performance_live", sql_of("menu_item_performance"))
def menu_item_performance_live(spark, sf):
    measures = ["quantity", "price", "n"]
    heads = PartialTable.scratch(spark, "menu-orders", ["order_id", "performance_date"], ["n"])
    items = PartialTable.scratch(spark, "menu-items", ["order_id", "menu_item_id"], measures)

    def sold(batch):
        rows = D.order_detail(spark, sf, raw=batch)
        return rows.select("order_id", "menu_item_id", F.col("quantity").cast("bigint").alias("quantity"), F.col("price").cast("decimal(28,4)").alias("price"), one())

    def placed(batch):
        return D.order_header(spark, sf, raw=batch).select("order_id", F.to_date("order_ts").alias("performance_date"), one())

    items.refresh(follow(spark, sf, "lineitem"), sold)
    heads.refresh(follow(spark, sf, "orders"), placed)
    per_day = order_lines(items, heads, ["performance_date"]).groupBy("performance_date", "menu_item_id")
    rows = per_day.agg(*[F.sum(c).alias(c) for c in measures]).select(
        "performance_date",
        "menu_item_id",
        F.col("n").alias("times_ordered"),
        F.col("quantity").alias("total_quantity"),
        F.col("price").alias("total_revenue"),
        (F.col("price").cast("double") / F.col("n")).alias("avg_price"),
    )
    return rows.join(D.menu(spark, sf).select("menu_item_id", "menu_item_name", "truck_brand_name"), "menu_item_id")


@query(
    "stream_daily_window",
    """SELECT strftime(day, '%Y-%m-%d %H:%M:%S') AS day, n, CAST(total AS DOUBLE) AS total FROM (SELECT date_trunc('day', ts) AS day, count(*) AS n,
  sum(CAST(value AS DECIMAL(18,4))) AS total FROM events GROUP BY 1)""",
)
def stream_daily_window(spark, sf):
    consumer = Consumer.scratch(spark, "daily-window")
    stream = follow(spark, sf, "events").select("ts", D.dec("value").alias("value"))
    consumer.run(stream, lambda batch: daily_parts(batch, "ts", "value"))
    return daily_totals(consumer.result())


@query(
    "stream_lookback",
    """SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS window_start, strftime(s + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS window_end, count(*) AS n FROM
(SELECT time_bucket(INTERVAL 15 MINUTE, ts) - to_minutes(15 * i) AS s FROM events, range(4) r(i) WHERE event_type = 'error') GROUP BY 1, 2""",
)
def stream_lookback(spark, sf):
    consumer = Consumer.scratch(spark, "lookback")
    errors = follow(spark, sf, "events").filter("event_type = 'error'").select("ts")
    consumer.run(errors, lambda batch: lookback_parts(batch, "ts", "1 hour", "15 minutes"))
    return lookback_totals(consumer.result())


@query("stream_dedup_once", "SELECT event_type, count(DISTINCT event_id) AS n FROM events GROUP BY 1")
def stream_dedup_once(spark, sf):
    """Every event is delivered twice; each counts once."""
    twice = follow(spark, sf, "events").select("event_id", "event_type", F.explode(F.array(F.lit(1), F.lit(2))).alias("delivery"))
    kept = append_stream(once(twice, ["event_id"]), "dedup")
    return kept.groupBy("event_type").agg(n_rows())
