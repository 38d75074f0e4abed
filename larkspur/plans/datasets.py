"""Named results of the sales jobs: enriched orders, star schema, weather and city sales."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import functions as F

from larkspur import domain as D
from larkspur.functions.units import round_half_up
from larkspur.operators.refresh import summarise_sales
from larkspur.plans.aggregates import n_rows, net_movement
from larkspur.plans.joins import calendar, initial_customer_dim
from larkspur.plans.projections import date_key, stock_status
from larkspur.registry import query

# --- e-commerce -----------------------------------------------------------

ENRICHED_SQL = """SELECT order_id, customer_id, customer_name, email, country, city, customer_segment, order_date, order_status, payment_method, shipping_cost,
  discount_amount, coalesce(lines, 0) AS total_items, gross AS subtotal, off AS item_discount, gross - off - discount_amount + shipping_cost AS total_amount
FROM v_orders JOIN v_customers USING (customer_id) LEFT JOIN
  (SELECT order_id, count(*) AS lines, sum(subtotal) AS gross, sum(line_discount) AS off FROM v_items GROUP BY 1) USING (order_id)"""


@query(
    "enriched_orders",
    f"""SELECT * REPLACE (strftime(order_date, '%Y-%m-%d') AS order_date, CAST(shipping_cost AS DOUBLE) AS shipping_cost,
  CAST(discount_amount AS DOUBLE) AS discount_amount, CAST(subtotal AS DOUBLE) AS subtotal, CAST(item_discount AS DOUBLE) AS item_discount,
  CAST(total_amount AS DOUBLE) AS total_amount) FROM ({ENRICHED_SQL})""",
)
def enriched_orders(spark, sf, **only):
    """One row per order; an order without lines keeps null amounts. ``only`` filters the orders (see the orders view)."""
    orders, items = D.orders(spark, sf, **only), D.order_items(spark, sf)
    if any(v is not None for v in only.values()):
        # few orders are asked for: their lines are found before any is priced
        items = items.join(orders.select("order_id"), "order_id", "left_semi")
    per_order = (
        D.line_amounts(items)
        .groupBy("order_id")
        .agg(
            n_rows("total_items"),
            F.sum("subtotal").alias("subtotal"),
            F.sum("line_discount").alias("item_discount"),
        )
    )
    buyers = D.customers(spark, sf).drop("phone", "signup_date")
    total = F.col("subtotal") - F.col("item_discount") - F.col("discount_amount") + F.col("shipping_cost")
    return (
        orders.join(buyers, "customer_id")
        .join(per_order, "order_id", "left")
        .select(
            "order_id",
            "customer_id",
            "customer_name",
            "email",
            "country",
            "city",
            "customer_segment",
            "order_date",
            "order_status",
            "payment_method",
            "shipping_cost",
            "discount_amount",
            F.coalesce("total_items", F.lit(0)).alias("total_items"),
            "subtotal",
            "item_discount",
            total.alias("total_amount"),
        )
    )


PERFORMANCE_SQL = """SELECT product_id, product_name, category, subcategory, brand, CAST(unit_price AS DOUBLE) AS unit_price, CAST(cost_price AS DOUBLE) AS cost_price,
  CAST(stock_quantity AS BIGINT) AS stock_quantity, order_count, total_quantity_sold, CAST(gross AS DOUBLE) AS gross_revenue,
  CAST(net AS DOUBLE) AS net_revenue, CAST(cost AS DOUBLE) AS total_cost, CAST(net - cost AS DOUBLE) AS profit,
  CASE WHEN cost > 0 THEN CAST(net - cost AS DOUBLE) / CAST(cost AS DOUBLE) * 100 ELSE 0 END AS profit_margin_percent FROM (
SELECT p.*, count(DISTINCT i.order_id) AS order_count, CAST(sum(i.quantity) AS BIGINT) AS total_quantity_sold,
  sum(i.subtotal) AS gross, sum(i.net_amount) AS net, sum(i.quantity * p.cost_price) AS cost
FROM v_products p LEFT JOIN v_items i ON p.product_id = i.product_id GROUP BY ALL)"""


@query("product_performance", PERFORMANCE_SQL)
def product_performance(spark, sf):
    """Sales per product; two aggregation steps keep a best-seller from filling one task."""
    per_order = (
        D.line_amounts(D.order_items(spark, sf))
        .groupBy("product_id", "order_id")
        .agg(F.sum("quantity").alias("q"), F.sum("subtotal").alias("g"), F.sum("net_amount").alias("n"))
    )
    sold = per_order.groupBy("product_id").agg(
        n_rows("order_count"),
        F.sum("q").alias("total_quantity_sold"),
        F.sum("g").alias("gross_revenue"),
        F.sum("n").alias("net_revenue"),
    )
    cost = D.dec(F.col("total_quantity_sold").cast("decimal(18,0)") * F.col("cost_price"), 34, 4)
    return (
        D.products(spark, sf)
        .join(sold, "product_id", "left")
        .withColumn("total_cost", cost)
        .withColumn("profit", F.col("net_revenue") - F.col("total_cost"))
        .select(
            "product_id",
            "product_name",
            "category",
            "subcategory",
            "brand",
            "unit_price",
            "cost_price",
            "stock_quantity",
            F.coalesce("order_count", F.lit(0)).alias("order_count"),
            "total_quantity_sold",
            "gross_revenue",
            "net_revenue",
            "total_cost",
            "profit",
            F.when(F.col("total_cost") > 0, F.col("profit").cast("double") / F.col("total_cost").cast("double") * 100)
            .otherwise(F.lit(0.0))
            .alias("profit_margin_percent"),
        )
    )


INVENTORY_SQL = """SELECT product_id, product_name, category, brand, CAST(stock_quantity AS BIGINT) AS initial_stock, net_movement,
  stock_quantity + net_movement AS current_stock, strftime(last_day, '%Y-%m-%d') AS last_movement_date,
  CASE WHEN stock_quantity + net_movement < 10 THEN 'LOW' WHEN stock_quantity + net_movement < 50 THEN 'MEDIUM' ELSE 'HEALTHY' END AS stock_status FROM (
SELECT p.product_id, p.product_name, p.category, p.brand, p.stock_quantity, CAST(coalesce(sum(CASE WHEN movement_type IN ('PURCHASE', 'RETURN')
  THEN quantity ELSE -quantity END), 0) AS BIGINT) AS net_movement, max(movement_date) AS last_day
FROM v_products p LEFT JOIN v_movements m ON p.product_id = m.product_id GROUP BY ALL)"""


@query("current_inventory", INVENTORY_SQL)
def current_inventory(spark, sf):
    moved = (
        D.inventory_movements(spark, sf)
        .groupBy("product_id")
        .agg(net_movement().alias("net_movement"), F.max("movement_date").alias("last_movement_date"))
    )
    return (
        D.products(spark, sf)
        .join(moved, "product_id", "left")
        .withColumn("net_movement", F.coalesce("net_movement", F.lit(0)))
        .withColumn("current_stock", F.col("stock_quantity") + F.col("net_movement"))
        .select(
            "product_id",
            "product_name",
            "category",
            "brand",
            F.col("stock_quantity").alias("initial_stock"),
            "net_movement",
            "current_stock",
            "last_movement_date",
            stock_status(F.col("current_stock")).alias("stock_status"),
        )
    )


@query(
    "dim_date",
    """SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_sk, strftime(d, '%Y-%m-%d') AS date_actual, CAST(dayofweek(d) AS BIGINT) AS day_of_week,
  strftime(d, '%a') AS day_name, CAST(day(d) AS BIGINT) AS day_of_month, CAST(dayofyear(d) AS BIGINT) AS day_of_year, CAST(weekofyear(d) AS BIGINT) AS week_of_year,
  CAST(month(d) AS BIGINT) AS month_number, strftime(d, '%b') AS month_name, CAST(quarter(d) AS BIGINT) AS quarter, CAST(year(d) AS BIGINT) AS year,
  dayofweek(d) IN (0, 6) AS is_weekend, FALSE AS is_holiday
FROM (SELECT CAST(unnest(generate_series(min(order_date), max(order_date), INTERVAL 1 DAY)) AS DATE) AS d FROM v_orders)""",
)
def dim_date(spark, sf):
    """Calendar over the days the orders span."""
    d = F.col("date_actual")
    days = calendar(D.orders(spark, sf).select(F.col("order_date").alias("date_actual")), "date_actual")
    return days.select(
        date_key("date_actual").alias("date_sk"),
        d,
        (F.dayofweek(d) - 1).alias("day_of_week"),
        F.dayname(d).alias("day_name"),
        F.day(d).alias("day_of_month"),
        F.dayofyear(d).alias("day_of_year"),
        F.weekofyear(d).alias("week_of_year"),
        F.month(d).alias("month_number"),
        F.monthname(d).alias("month_name"),
        F.quarter(d).alias("quarter"),
        F.year(d).alias("year"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
        F.lit(False).alias("is_holiday"),
    )


def initial_product_dim(spark, sf):
    return D.products(spark, sf).select(
        (F.col("product_id") + 1).alias("product_sk"),
        "product_id",
        "product_name",
        "category",
        "subcategory",
        "brand",
        "unit_price",
        "cost_price",
        F.lit(date(1995, 1, 1)).alias("effective_date"),
        F.to_date(F.lit("9999-12-31")).alias("end_date"),
        F.lit(True).alias("is_current"),
    )


FACT_SQL = """SELECT o.order_id, o.customer_id + 1 AS customer_sk, i.product_id + 1 AS product_sk, CAST(strftime(o.order_date, '%Y%m%d') AS BIGINT) AS date_sk,
  i.order_item_id, i.quantity, i.unit_price, i.discount_percent, i.line_discount AS discount_amount, i.subtotal, i.net_amount,
  i.quantity * p.cost_price AS cost_amount, i.net_amount - i.quantity * p.cost_price AS profit_amount, o.order_status, o.payment_method, o.order_date
FROM v_items i JOIN v_orders o USING (order_id) JOIN v_products p USING (product_id) JOIN v_customers c ON o.customer_id = c.customer_id"""


@query(
    "fact_sales",
    f"""SELECT order_id, customer_sk, product_sk, date_sk, order_item_id, CAST(quantity AS BIGINT) AS quantity, CAST(unit_price AS DOUBLE) AS unit_price,
  CAST(discount_percent AS BIGINT) AS discount_percent, CAST(discount_amount AS DOUBLE) AS discount_amount, CAST(subtotal AS DOUBLE) AS subtotal,
  CAST(net_amount AS DOUBLE) AS net_amount, CAST(cost_amount AS DOUBLE) AS cost_amount, CAST(profit_amount AS DOUBLE) AS profit_amount, order_status,
  payment_method FROM ({FACT_SQL})""",
)
def fact_sales(spark, sf, **only):
    return build_fact_sales(
        D.line_rows(spark, sf),
        D.orders(spark, sf, **only),
        initial_customer_dim(spark, sf),
        initial_product_dim(spark, sf),
    )


def sold_by(orders, dim_customer):
    """Orders with the current version of their customer."""
    buyers = dim_customer.filter("is_current").select("customer_id", "customer_sk")
    return orders.select("order_id", "customer_id", "order_date", "order_status", "payment_method").join(buyers, "customer_id")


def costed(lines, dim_product):
    """Lines with the current version of their product."""
    goods = dim_product.filter("is_current").select("product_id", "product_sk", "cost_price")
    return lines.join(goods, "product_id")


def fact_amounts(rows):
    """Adds all amounts of costed lines."""
    cost = D.dec(F.col("quantity").cast("decimal(7,0)") * F.col("cost_price"))
    rows = D.line_amounts(rows).withColumn("cost_amount", cost)
    return rows.withColumn("profit_amount", F.col("net_amount") - F.col("cost_amount"))


def build_fact_sales(lines, orders, dim_customer, dim_product):
    """Order lines against the current version of customer and product; the joins carry what amounts and line keys are built from, not these."""
    rows = costed(lines, dim_product).join(sold_by(orders, dim_customer), "order_id")
    return (
        fact_amounts(rows)
        .withColumn("order_item_id", D.line_key())
        .select(
            "order_id",
            "customer_sk",
            "product_sk",
            date_key("order_date").alias("date_sk"),
            "order_item_id",
            "quantity",
            "unit_price",
            "discount_percent",
            F.col("line_discount").alias("discount_amount"),
            "subtotal",
            "net_amount",
            "cost_amount",
            "profit_amount",
            "order_status",
            "payment_method",
        )
    )


DAILY_SQL = f"""SELECT order_date AS summary_date, count(DISTINCT order_id) AS total_orders, sum(net_amount) AS total_revenue, sum(profit_amount) AS total_profit,
  CAST(sum(quantity) AS BIGINT) AS total_quantity, count(DISTINCT customer_sk) AS unique_customers, CAST(sum(net_amount) AS DOUBLE) / count(*) AS avg_line_value
FROM ({FACT_SQL}) GROUP BY 1"""
DAILY_PLAIN_SQL = f"""SELECT * REPLACE (strftime(summary_date, '%Y-%m-%d') AS summary_date, CAST(total_revenue AS DOUBLE) AS total_revenue,
  CAST(total_profit AS DOUBLE) AS total_profit) FROM ({DAILY_SQL})"""


@query("daily_sales_summary", DAILY_PLAIN_SQL)
def daily_sales_summary(spark, sf, **only):
    return summarise_sales(fact_sales(spark, sf, **only), dim_date(spark, sf))


# --- food trucks ----------------------------------------------------------


@query(
    "customer_loyalty_metrics",
    """SELECT l.customer_id, l.city, l.country, l.first_name, l.last_name, l.phone_number, l.e_mail, CAST(sum(h.order_total) AS DOUBLE) AS total_sales,
  array_to_string(list_sort(list(DISTINCT CAST(h.location_id AS BIGINT))), ',') AS visited_location_ids_array
FROM v_loyalty l JOIN v_header h ON l.customer_id = h.customer_id GROUP BY 1, 2, 3, 4, 5, 6, 7""",
)
def customer_loyalty_metrics(spark, sf):
    spend = (
        D.order_header(spark, sf)
        .filter("customer_id IS NOT NULL")
        .groupBy("customer_id")
        .agg(
            F.sum("order_total").alias("total_sales"),
            F.sort_array(F.collect_set(F.col("location_id").cast("bigint"))).alias("visited_location_ids_array"),
        )
    )
    member = D.customer_loyalty(spark, sf).select(
        "customer_id", "city", "country", "first_name", "last_name", "phone_number", "e_mail"
    )
    return member.join(spend, "customer_id")


@query(
    "daily_weather",
    """SELECT strftime(date_valid_std, '%Y-%m-%d') AS date, postal_code, city_name, country, strftime(date_valid_std, '%Y-%m') AS yyyy_mm,
  CAST(avg_temperature_f AS DOUBLE) AS avg_temperature_f, CAST(tot_precipitation_in AS DOUBLE) AS tot_precipitation_in, CAST(max_wind_mph AS DOUBLE) AS max_wind_mph
FROM v_weather JOIN v_postal USING (postal_code, country) JOIN (SELECT city AS city_name, country FROM v_location) USING (city_name, country)""",
)
def daily_weather(spark, sf):
    """Weather of the supported cities, one row per day and postal code."""
    served = D.location(spark, sf).select(F.col("city").alias("city_name"), "country").distinct()
    return (
        D.history_day(spark, sf)
        .join(D.postal_codes(spark, sf), ["postal_code", "country"])
        .join(served, ["city_name", "country"])
        .select(
            F.col("date_valid_std").alias("date"),
            "postal_code",
            "city_name",
            "country",
            F.date_format("date_valid_std", "yyyy-MM").alias("yyyy_mm"),
            "avg_temperature_f",
            "tot_precipitation_in",
            "max_wind_mph",
        )
    )


def city_weather(spark, sf):
    """One row per day and city, averaged over its postal codes."""
    return (
        daily_weather(spark, sf)
        .groupBy("date", "city_name", "country")
        .agg(
            D.mean("avg_temperature_f").alias("temperature_f"),
            D.mean("tot_precipitation_in").alias("precipitation_in"),
            F.max("max_wind_mph").alias("max_wind_mph"),
        )
    )


def _header_city(spark, sf, since=None, until=None):
    place = D.location(spark, sf).select("location_id", F.col("city").alias("city_name"), "country")
    return (
        D.order_header(spark, sf, since=since, until=until)
        .withColumn("location_id", F.col("location_id").cast("bigint"))
        .join(place, "location_id")
        .withColumn("date", F.to_date("order_ts"))
    )


def city_orders(spark, sf, since=None, until=None):
    """Number and total of orders per day and city."""
    return (
        _header_city(spark, sf, since, until)
        .groupBy("date", "city_name", "country")
        .agg(n_rows("orders"), F.sum("order_total").alias("order_total"))
    )


def city_line_sales(spark, sf, since=None, until=None, city=None):
    """Line sales per day and city; lines are reduced to one row per order before the join.

    A period or city narrows the lines to its orders before they are added up.
    """
    header, detail = _header_city(spark, sf, since, until), D.order_detail(spark, sf)
    if city is not None:
        header = header.filter(F.col("city_name") == city)
    if since is not None or until is not None or city is not None:
        detail = detail.join(header.select("order_id"), "order_id", "left_semi")
    per_order = detail.groupBy("order_id").agg(F.sum("price").alias("price"))
    return (
        header.join(per_order, "order_id")
        .groupBy("date", "city_name", "country")
        .agg(F.sum("price").alias("daily_sales"))
    )


CITY = "CITY_3"
MONTH_START, MONTH_END = date(1997, 2, 1), date(1997, 2, 28)

CITY_SALES_SQL = """SELECT CAST(h.order_ts AS DATE) AS date, l.city AS city_name, l.country, sum(d.price) AS daily_sales
FROM v_header h JOIN v_location l ON CAST(h.location_id AS BIGINT) = l.location_id JOIN v_detail d ON d.order_id = h.order_id GROUP BY 1, 2, 3"""
CITY_WEATHER_SQL = """SELECT date_valid_std AS date, city_name, country, CAST(sum(avg_temperature_f) AS DOUBLE) / count(*) AS temperature_f,
  CAST(sum(tot_precipitation_in) AS DOUBLE) / count(*) AS precipitation_in, max(max_wind_mph) AS max_wind_mph
FROM v_weather JOIN v_postal USING (postal_code, country) JOIN (SELECT city AS city_name, country FROM v_location) USING (city_name, country) GROUP BY 1, 2, 3"""


@query(
    "city_daily_sales",
    f"""SELECT strftime(d, '%Y-%m-%d') AS date, CAST(coalesce(daily_sales, 0) AS DOUBLE) AS daily_sales
FROM (SELECT CAST(unnest(generate_series(DATE '1997-02-01', DATE '1997-02-28', INTERVAL 1 DAY)) AS DATE) AS d)
LEFT JOIN (SELECT date, sum(daily_sales) AS daily_sales FROM ({CITY_SALES_SQL}) WHERE city_name = '{CITY}' GROUP BY 1) s ON s.date = d""",
)
def city_daily_sales(spark, sf, city: str = CITY, start: date = MONTH_START, end: date = MONTH_END):
    """Sales of one city per day of a period; days without orders show 0."""
    sold = (
        city_line_sales(spark, sf, start, end, city)
        .groupBy("date")
        .agg(F.sum("daily_sales").alias("daily_sales"))
    )
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end))).alias("date"))
    return days.join(sold, "date", "left").withColumn("daily_sales", F.coalesce("daily_sales", F.lit(0)))


def _city_month(df, city, start, end):
    return df.filter((F.col("city_name") == city) & F.col("date").between(start, end))


@query(
    "city_temperature",
    f"""SELECT strftime(date, '%Y-%m-%d') AS date, temperature_f AS avg_temperature FROM ({CITY_WEATHER_SQL})
WHERE city_name = '{CITY}' AND year(date) = 1997 AND month(date) = 2""",
)
def city_temperature(spark, sf, city: str = CITY, start: date = MONTH_START, end: date = MONTH_END):
    return _city_month(city_weather(spark, sf), city, start, end).select("date", F.col("temperature_f").alias("avg_temperature"))


@query(
    "city_windspeed",
    f"""SELECT strftime(date, '%Y-%m-%d') AS date, country, city_name, CAST(max_wind_mph AS DOUBLE) AS max_wind_mph FROM ({CITY_WEATHER_SQL})
WHERE city_name = '{CITY}' AND year(date) = 1997 AND month(date) = 2""",
)
def city_windspeed(spark, sf, city: str = CITY, start: date = MONTH_START, end: date = MONTH_END):
    """Strongest wind per day, newest first, as a statement with bound parameters."""
    return spark.sql(
        """SELECT date, country, city_name, max(max_wind_mph) AS max_wind_mph FROM {weather}
        WHERE city_name = :city AND date BETWEEN :start AND :end GROUP BY country, city_name, date ORDER BY date DESC""",
        args={"city": city, "start": start, "end": end},
        weather=daily_weather(spark, sf),
    )


R2 = "sign({x}) * floor(abs({x}) * 100 + 0.5) / 100"
METRICS_SQL = f"""SELECT strftime(w.date, '%Y-%m-%d') AS date, w.city_name, w.country, CAST(coalesce(s.daily_sales, 0) AS DOUBLE) AS daily_sales,
  {R2.format(x='temperature_f')} AS avg_temperature_fahrenheit, {R2.format(x='((temperature_f - 32) * 5 / 9)')} AS avg_temperature_celsius,
  {R2.format(x='precipitation_in')} AS avg_precipitation_inches, {R2.format(x='(precipitation_in * 25.4::DOUBLE)')} AS avg_precipitation_millimeters,
  CAST(max_wind_mph AS DOUBLE) AS max_wind_speed_100m_mph
FROM ({CITY_WEATHER_SQL}) w LEFT JOIN ({CITY_SALES_SQL}) s USING (date, city_name, country)"""


@query("daily_city_metrics", METRICS_SQL)
def daily_city_metrics(spark, sf, since: date | None = None, until: date | None = None, city: str | None = None):
    """Sales and weather per day and city. Both sides are one row per key, so neither inflates the other."""
    f, inch = F.col("temperature_f"), F.col("precipitation_in")
    return (
        city_weather(spark, sf)
        .join(city_line_sales(spark, sf, since, until, city), ["date", "city_name", "country"], "left")
        .select(
            "date",
            "city_name",
            "country",
            F.coalesce("daily_sales", F.lit(0)).alias("daily_sales"),
            round_half_up(f, 2).alias("avg_temperature_fahrenheit"),
            round_half_up((f - 32) * 5 / 9, 2).alias("avg_temperature_celsius"),
            round_half_up(inch, 2).alias("avg_precipitation_inches"),
            round_half_up(inch * F.lit(25.4), 2).alias("avg_precipitation_millimeters"),
            F.col("max_wind_mph").alias("max_wind_speed_100m_mph"),
        )
    )


@query("weather_city", f"SELECT * FROM ({METRICS_SQL}) WHERE city_name = '{CITY}' AND date LIKE '1997-02-%'")
def weather_city(spark, sf, city: str = CITY, start: date = MONTH_START, end: date = MONTH_END):
    return _city_month(daily_city_metrics(spark, sf, start, end, city), city, start, end)


def _with_amounts(header):
    """Text amounts become decimals, missing ones count as 0."""

    def money(name):
        return F.coalesce(D.dec(name), F.lit(0)).cast("decimal(18,4)").alias(name)

    return header.select(
        F.to_date("order_ts").alias("sales_date"),
        "order_id",
        "customer_id",
        "truck_id",
        F.col("location_id").cast("bigint").alias("location_id"),
        money("order_total"),
        money("order_tax_amount"),
        money("order_discount_amount"),
    )


@query(
    "daily_sales_by_brand",
    """SELECT strftime(CAST(h.order_ts AS DATE), '%Y-%m-%d') AS sales_date, m.truck_brand_name, t.primary_city, t.region, t.country, count(*) AS total_orders,
  CAST(sum(order_total) AS DOUBLE) AS total_revenue, CAST(sum(CAST(coalesce(order_tax_amount, '0') AS DECIMAL(18,4))) AS DOUBLE) AS total_tax,
  CAST(sum(CAST(order_discount_amount AS DECIMAL(18,4))) AS DOUBLE) AS total_discount, count(DISTINCT customer_id) AS unique_customers,
  CAST(sum(order_total) AS DOUBLE) / count(*) AS avg_order_value
FROM v_header h JOIN v_truck t ON h.truck_id = t.truck_id JOIN (SELECT DISTINCT menu_type_id, truck_brand_name FROM v_menu) m ON t.menu_type_id = m.menu_type_id
GROUP BY 1, 2, 3, 4, 5""",
)
def daily_sales_by_brand(spark, sf):
    return brand_sales(D.order_header(spark, sf), D.truck(spark, sf), D.menu(spark, sf))


BRAND_KEYS = ["sales_date", "truck_brand_name", "primary_city", "region", "country"]


def brand_rows(header, trucks, menu):
    """Headers with their brand and place. The menu lists a brand once per item, so brands are made distinct before the join, not after it."""
    brands = menu.select("menu_type_id", "truck_brand_name").distinct()
    trucks = trucks.select("truck_id", "primary_city", "region", "country", "menu_type_id")
    return _with_amounts(header).join(trucks.join(brands, "menu_type_id"), "truck_id")


def brand_sales(header, trucks, menu):
    return brand_rows(header, trucks, menu).groupBy(*BRAND_KEYS).agg(
        n_rows("total_orders"),
        F.sum("order_total").alias("total_revenue"),
        F.sum("order_tax_amount").alias("total_tax"),
        F.sum("order_discount_amount").alias("total_discount"),
        F.count_distinct("customer_id").alias("unique_customers"),
        D.mean("order_total").alias("avg_order_value"),
    )


@query(
    "regional_sales",
    """SELECT strftime(CAST(h.order_ts AS DATE), '%Y-%m-%d') AS sales_date, l.city, l.country, t.region, count(*) AS order_count,
  CAST(sum(order_total) AS DOUBLE) AS total_revenue, count(DISTINCT customer_id) AS unique_customers, count(DISTINCT h.truck_id) AS unique_trucks,
  CAST(sum(order_total) AS DOUBLE) / count(*) AS avg_order_value
FROM v_header h JOIN v_location l ON CAST(h.location_id AS BIGINT) = l.location_id JOIN v_truck t ON h.truck_id = t.truck_id GROUP BY 1, 2, 3, 4""",
)
def regional_sales(spark, sf):
    return regional_rows(spark, sf, D.order_header(spark, sf)).groupBy(*REGION_KEYS).agg(
        n_rows("order_count"),
        F.sum("order_total").alias("total_revenue"),
        F.count_distinct("customer_id").alias("unique_customers"),
        F.count_distinct("truck_id").alias("unique_trucks"),
        D.mean("order_total").alias("avg_order_value"),
    )


REGION_KEYS = ["sales_date", "city", "country", "region"]


def regional_rows(spark, sf, header):
    place = D.location(spark, sf).select("location_id", "city", "country")
    trucks = D.truck(spark, sf).select("truck_id", "region")
    return _with_amounts(header).join(place, "location_id").join(trucks, "truck_id")


@query(
    "customer_activity",
    """WITH heads AS (SELECT customer_id, CAST(order_ts AS DATE) AS d, count(*) AS order_count, sum(order_total) AS spent, max(order_ts) AS last_ts,
  list_sort(list(DISTINCT CAST(location_id AS BIGINT))) AS places FROM v_header GROUP BY 1, 2),
goods AS (SELECT customer_id, CAST(order_ts AS DATE) AS d, list_sort(list(DISTINCT menu_item_name)) AS names FROM v_header JOIN v_detail USING (order_id)
  JOIN v_menu USING (menu_item_id) GROUP BY 1, 2)
SELECT heads.customer_id, strftime(heads.d, '%Y-%m-%d') AS activity_date, order_count, CAST(spent AS DOUBLE) AS total_spent, array_to_string(names, ',') AS favorite_menu_items,
  array_to_string(places, ',') AS visited_locations, strftime(last_ts, '%Y-%m-%d %H:%M:%S') AS last_order_timestamp FROM heads LEFT JOIN goods
  ON heads.d = goods.d AND heads.customer_id IS NOT DISTINCT FROM goods.customer_id""",
)
def customer_activity(spark, sf):
    """Orders are counted from headers and items from lines, so that no total repeats per line."""
    header = D.order_header(spark, sf)
    heads = visits(header).groupBy("customer_id", "activity_date").agg(
        n_rows("order_count"),
        F.sum("total_spent").alias("total_spent"),
        F.sort_array(F.collect_set("location_id")).alias("visited_locations"),
        F.max("order_ts").alias("last_order_timestamp"),
    )
    bought = D.order_detail(spark, sf).join(buyers(header), "order_id").select("customer_id", "activity_date", "menu_item_id").distinct()
    return with_favorites(heads, bought, D.menu(spark, sf))


def visits(header):
    total = F.coalesce("order_total", F.lit(0)).cast("decimal(18,4)").alias("total_spent")
    place = F.col("location_id").cast("bigint").alias("location_id")
    return header.select("customer_id", F.to_date("order_ts").alias("activity_date"), place, total, "order_ts")


def buyers(header):
    return header.select("order_id", "customer_id", F.to_date("order_ts").alias("activity_date"))


def with_favorites(heads, bought, menu):
    """Adds the names of the different items bought; orders without a customer form a group of their own."""
    names = (
        bought.join(menu.select("menu_item_id", "menu_item_name"), "menu_item_id")
        .groupBy("customer_id", "activity_date")
        .agg(F.sort_array(F.collect_set("menu_item_name")).alias("favorite_menu_items"))
        .withColumnsRenamed({"customer_id": "c", "activity_date": "d"})
    )
    same = F.col("customer_id").eqNullSafe(F.col("c")) & (F.col("activity_date") == F.col("d"))
    return heads.join(names, same, "left").drop("c", "d")


@query(
    "menu_item_performance",
    """SELECT strftime(CAST(h.order_ts AS DATE), '%Y-%m-%d') AS performance_date, d.menu_item_id, m.menu_item_name, m.truck_brand_name, count(*) AS times_ordered,
  CAST(sum(d.quantity) AS BIGINT) AS total_quantity, CAST(sum(d.price) AS DOUBLE) AS total_revenue, CAST(sum(d.price) AS DOUBLE) / count(*) AS avg_price
FROM v_detail d JOIN v_menu m USING (menu_item_id) JOIN v_header h USING (order_id) GROUP BY 1, 2, 3, 4""",
)
def menu_item_performance(spark, sf):
    days = D.order_header(spark, sf).select("order_id", F.to_date("order_ts").alias("performance_date"))
    sold = (
        D.order_detail(spark, sf)
        .join(days, "order_id")
        .groupBy("performance_date", "menu_item_id")
        .agg(
            n_rows("times_ordered"),
            F.sum("quantity").alias("total_quantity"),
            F.sum("price").alias("total_revenue"),
            D.mean("price").alias("avg_price"),
        )
    )
    return sold.join(D.menu(spark, sf).select("menu_item_id", "menu_item_name", "truck_brand_name"), "menu_item_id")


# --- time series ----------------------------------------------------------


def added_up(points, period):
    """Exact total and number of the points of each variable and period."""
    return points.groupBy("variable", period).agg(F.sum("value").alias("total"), F.count("value").alias("points"))


@query(
    "annual_wages_cpi",
    """WITH j AS (SELECT year(w.date) AS year, wa.variable_name AS wn, pa.variable_name AS pn, w.value AS wv, p.n, p.total
FROM v_wages w JOIN v_wage_attributes wa USING (variable) LEFT JOIN
  (SELECT year(date) AS y, variable, count(*) AS n, sum(value) AS total FROM v_prices WHERE geo_id = 'country/USA' GROUP BY 1, 2) p ON p.y = year(w.date)
LEFT JOIN v_price_attributes pa ON p.variable = pa.variable
WHERE (wa.variable_name ILIKE '%annual wages%' OR pa.variable_name ILIKE '%CPI%') AND w.geo_id = 'country/USA' AND year(w.date) BETWEEN 1996 AND 2000),
wages AS (SELECT year(date) AS year, CAST(sum(value) FILTER (variable_name ILIKE '%annual wages%') AS DOUBLE) / nullif(count(value) FILTER (variable_name ILIKE '%annual wages%'), 0) AS w
  FROM v_wages JOIN v_wage_attributes USING (variable) WHERE geo_id = 'country/USA' GROUP BY 1),
prices AS (SELECT year(date) AS year, CAST(sum(value) AS DOUBLE) / count(*) AS c FROM v_prices JOIN v_price_attributes USING (variable)
  WHERE geo_id = 'country/USA' AND variable_name ILIKE '%CPI%' GROUP BY 1)
SELECT CAST(y.year AS BIGINT) AS year, floor(w + 0.5) AS avg_annual_wages, floor(c + 0.5) AS cpi
FROM (SELECT DISTINCT year FROM j) y LEFT JOIN wages USING (year) LEFT JOIN prices USING (year)""",
)
def annual_wages_cpi(spark, sf, geo: str = "country/USA", first: int = 1996, last: int = 2000):
    """Average wage and price index per year.

    The source pairs all wage rows with all price rows of a year. Averages survive
    that duplication, so both sides are reduced to one row per year before they meet. The
    variables are few and hot: points are added up per variable before they meet its name.
    """
    years = date(first, 1, 1), date(last, 12, 31)
    w = added_up(D.wage_series(spark, sf, *years).filter(F.col("geo_id") == geo), F.year("date").alias("year"))
    named = F.col("variable_name").ilike("%annual wages%")
    total, points = F.sum(F.when(named, F.col("total"))), F.sum(F.when(named, F.col("points")).otherwise(0))
    wages = (
        w.join(D.wage_attributes(spark, sf), "variable")
        .groupBy("year")
        .agg(F.try_divide(total.cast("double"), points).alias("w"), points.alias("n_wages"))
    )
    prices = (
        added_up(D.price_series(spark, sf, *years).filter(F.col("geo_id") == geo), F.year("date").alias("year"))
        .join(D.price_attributes(spark, sf).filter(F.col("variable_name").ilike("%CPI%")), "variable")
        .groupBy("year")
        .agg(F.try_divide(F.sum("total").cast("double"), F.sum("points")).alias("c"))
    )
    return (
        wages.join(prices, "year", "left")
        .filter("n_wages > 0 OR c IS NOT NULL")
        .select(
            "year",
            F.floor(F.col("w") + 0.5).cast("double").alias("avg_annual_wages"),
            F.floor(F.col("c") + 0.5).cast("double").alias("cpi"),
        )
    )


@query(
    "monthly_cpi",
    """SELECT strftime(date, '%Y-%m') AS month, floor(CAST(sum(value) AS DOUBLE) / count(*) * 10 + 0.5) / 10 AS avg_cpi FROM v_prices
JOIN v_price_attributes USING (variable) WHERE variable_name ILIKE '%CPI%' AND geo_id = 'country/USA'
AND date_trunc('month', date) BETWEEN DATE '1998-08-01' AND DATE '2001-08-01' GROUP BY 1""",
)
def monthly_cpi(spark, sf, as_of: date = D.AS_OF_ORDERS, years: int = 3):
    cpi = D.price_attributes(spark, sf).filter(F.col("variable_name").ilike("%CPI%"))
    # whole months whose first day lies in the period
    start = as_of.replace(year=as_of.year - years)
    start = start if start.day == 1 else (start.replace(day=1) + timedelta(days=32)).replace(day=1)
    end = (as_of.replace(day=1) + timedelta(days=32)).replace(day=1) - timedelta(days=1)
    prices = D.price_series(spark, sf, start, end).filter(F.col("geo_id") == "country/USA")
    return (
        added_up(prices, F.date_format("date", "yyyy-MM").alias("month"))
        .join(cpi, "variable")
        .groupBy("month")
        .agg(round_half_up(F.sum("total").cast("double") / F.sum("points"), 1).alias("avg_cpi"))
    )


@query(
    "city_sales_range",
    """SELECT strftime(CAST(order_ts AS DATE), '%Y-%m-%d') AS date, city AS city_name, CAST(sum(order_total) AS DOUBLE) AS total_sales
FROM v_header h JOIN v_location l ON CAST(h.location_id AS BIGINT) = l.location_id
WHERE city IN ('CITY_1', 'CITY_3', 'CITY_7') AND year(order_ts) BETWEEN 1997 AND 1999 GROUP BY 1, 2""",
)
def city_sales_range(spark, sf, cities=("CITY_1", "CITY_3", "CITY_7"), first: int = 1997, last: int = 1999):
    """Order totals per day of the chosen cities; each order counts once."""
    return (
        city_orders(spark, sf, date(first, 1, 1), date(last, 12, 31))
        .filter(F.col("city_name").isin(*cities))
        .select("date", "city_name", F.col("order_total").alias("total_sales"))
    )
