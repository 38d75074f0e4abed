"""Retail, food-truck, telemetry and time-series views over the raw tables.

Every view is a narrow, lazy projection: Catalyst prunes the columns a query does
not use and pushes its filters into the scan. Money is decimal and small enough
(18 digits) to stay in the long-backed fast path.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF_ORDERS = date(2001, 8, 1)
AS_OF_EVENTS = datetime(2024, 1, 31)

# The five order priorities stand for the five payment methods.
PAYMENT_METHODS = {
    "1-URGENT": "Credit Card",
    "2-HIGH": "PayPal",
    "3-MEDIUM": "Debit Card",
    "4-NOT SPECIFIED": "Bank Transfer",
    "5-LOW": "Cash on Delivery",
}
# Order status codes.
ORDER_STATUS = {"F": "COMPLETED", "O": "PROCESSING", "P": "PENDING"}
# Menu type numbers.
MENU_TYPES = {"ECONOMY": 0, "LARGE": 1, "MEDIUM": 2, "PROMO": 3, "SMALL": 4, "STANDARD": 5}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lookup(col: Column, mapping: dict, default=None) -> Column:
    """CASE mapping of a column through a fixed dictionary."""
    items = list(mapping.items())
    out = F.when(col == F.lit(items[0][0]), F.lit(items[0][1]))
    for key, value in items[1:]:
        out = out.when(col == F.lit(key), F.lit(value))
    return out.otherwise(F.lit(default))


def renamed(col: Column, mapping: dict) -> Column:
    """Codes as names; a code the dictionary does not know stays itself, so that its rows are still told apart."""
    return lookup(col, mapping, col)


def codes_of(names, mapping: dict) -> list:
    """The stored codes of names; a name of no code is a code itself."""
    known = set(mapping.values())
    return [code for code, name in mapping.items() if name in names] + [name for name in names if name not in known]


def dec(col: Column | str, precision: int = 18, scale: int = 4) -> Column:
    col = F.col(col) if isinstance(col, str) else col
    return col.cast(f"decimal({precision},{scale})")


def cents(units: Column) -> Column:
    """Exact hundredths of a whole number of up to twelve digits."""
    return units.cast("decimal(12,0)") * F.lit(Decimal("0.01"))


def mean(col: Column | str) -> Column:
    """Average as double from an exact decimal sum: the same bits in every engine and plan."""
    return F.sum(col).cast("double") / F.count(col)


def text_id(col: Column | str) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("string")


# --- e-commerce -----------------------------------------------------------


def _email(key: Column) -> Column:
    return F.concat(F.lit("customer"), text_id(key), F.when(key % 97 == 0, "").otherwise("@email.com"))


def _phone(key: Column) -> Column:
    return F.concat(F.lit("+1-555-"), F.lpad(text_id(key % 10000), 4, "0"))


def customers(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey"), F.col("n_name"))
    key = F.col("c_custkey")
    return c.join(n, c.c_nationkey == n.n_nationkey).select(
        key.alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        _email(key).alias("email"),
        _phone(key).alias("phone"),
        F.col("n_name").alias("country"),
        F.concat(F.lit("CITY_"), text_id(key % 15)).alias("city"),
        F.date_add(F.lit(date(1995, 1, 1)), (key % 730).cast("int")).alias("signup_date"),
        F.col("c_mktsegment").alias("customer_segment"),
    )


def products(spark, sf_dir):
    key, size = F.col("p_partkey"), F.col("p_size")
    price = dec("p_retailprice", 10, 2)
    return table(spark, sf_dir, "part").select(
        key.alias("product_id"),
        F.concat(F.col("p_name"), F.lit(" Model-"), text_id(key)).alias("product_name"),
        F.col("p_type").alias("category"),
        F.concat(F.lit("SIZE_"), text_id(F.floor(size / 10))).alias("subcategory"),
        F.col("p_brand").alias("brand"),
        price.alias("unit_price"),
        dec(price * cents(size + 40), 12, 4).alias("cost_price"),
        (size * 10).alias("stock_quantity"),
    )


def _days(raw: DataFrame, since: date | None, until: date | None, stored: str = "o_orderdate") -> DataFrame:
    """Raw rows dated in [since, until], as a range on the stored column so that the scan can prune."""
    day = F.col(stored)
    if since is not None:
        raw = raw.filter(day >= F.lit(since).cast("timestamp_ntz"))
    if until is not None:
        raw = raw.filter(day < F.lit(until + timedelta(days=1)).cast("timestamp_ntz"))
    return raw


def orders(spark, sf_dir, status=None, payment=None, since: date | None = None, until: date | None = None, raw: DataFrame | None = None):
    """Orders; the optional filters apply to the stored codes and dates and reach the scan.

    ``status`` is one name or several. A filter on the renamed columns gives the same
    rows but hides behind the CASE mapping, where no scan can use it.
    """
    raw = _days(table(spark, sf_dir, "orders") if raw is None else raw, since, until)
    if status is not None:
        names = [status] if isinstance(status, str) else list(status)
        raw = raw.filter(F.col("o_orderstatus").isin(codes_of(names, ORDER_STATUS)))
    if payment is not None:
        raw = raw.filter(F.col("o_orderpriority").isin(codes_of([payment], PAYMENT_METHODS)))
    key = F.col("o_orderkey")
    return raw.select(
        key.alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.to_date("o_orderdate").alias("order_date"),
        renamed(F.col("o_orderstatus"), ORDER_STATUS).alias("order_status"),
        renamed(F.col("o_orderpriority"), PAYMENT_METHODS).alias("payment_method"),
        dec(key % 46 + 5, 8, 2).alias("shipping_cost"),
        dec(key % 101, 8, 2).alias("discount_amount"),
    )


def line_rows(spark, sf_dir, raw: DataFrame | None = None):
    """Order lines, or those of ``raw`` rows of the table such as a batch of it, in numbers only: what a shuffle should carry."""
    # floor(x + 0.5) stays on primitive doubles; round() would box every value
    whole_cents = F.floor(F.col("l_extendedprice") * 100 + 0.5)
    unit_cents = F.call_function("div", whole_cents, F.col("l_quantity").cast("bigint"))
    raw = table(spark, sf_dir, "lineitem") if raw is None else raw
    return raw.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("supplier_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        dec(cents(unit_cents), 10, 2).alias("unit_price"),
        F.floor(F.col("l_discount") * 100 + 0.5).cast("int").alias("discount_percent"),
    )


def line_key() -> Column:
    """The text key of a line, built from the row itself, so no shuffle numbers it."""
    return F.concat_ws("-", "order_id", "line_number", "product_id", "supplier_id")


def order_items(spark, sf_dir, raw: DataFrame | None = None):
    """Order lines, or those of ``raw`` rows of the table such as a batch of it, with their text key and stored unit price."""
    return line_rows(spark, sf_dir, raw).select(
        line_key().alias("order_item_id"), "order_id", "line_number", "product_id", "quantity", "unit_price", "discount_percent"
    )


def line_price() -> Column:
    return dec(F.col("quantity").cast("decimal(7,0)") * F.col("unit_price").cast("decimal(10,2)"))


def line_amounts(items: DataFrame) -> DataFrame:
    """Adds subtotal, discount and net of each line, exact to four decimals."""
    qty = F.col("quantity").cast("decimal(7,0)")
    rate = cents(F.col("discount_percent")).cast("decimal(3,2)")
    subtotal = qty * F.col("unit_price").cast("decimal(10,2)")
    return (
        items.withColumn("subtotal", dec(subtotal))
        .withColumn("line_discount", dec(subtotal * rate))
        .withColumn("net_amount", F.col("subtotal") - F.col("line_discount"))
        .withColumn("net_amount", dec("net_amount"))
    )


def inventory_movements(spark, sf_dir, since: date | None = None, until: date | None = None):
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    return _days(table(spark, sf_dir, "lineitem"), since, until, "l_shipdate").select(
        F.col("l_partkey").alias("product_id"),
        F.when((flag == "N") & (status == "F"), "PURCHASE")
        .when(flag == "N", "SALE")
        .when(flag == "R", "RETURN")
        .otherwise("ADJUSTMENT")
        .alias("movement_type"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.to_date("l_shipdate").alias("movement_date"),
        F.col("l_orderkey").alias("reference_id"),
    )


# --- food trucks ----------------------------------------------------------


def header_rows(spark, sf_dir, raw: DataFrame | None = None, since: date | None = None, until: date | None = None):
    """Order headers of the orders table, or of ``raw`` rows of it such as a micro-batch, without what ``header_details`` derives.

    ``since`` and ``until`` are days of ``order_ts``. The time of day may carry an order
    into the next day, so the scan starts one day early and the exact test follows.
    """
    key = F.col("o_orderkey")
    trucks = table(spark, sf_dir, "supplier").agg(F.count(F.lit(1))).scalar()
    raw = table(spark, sf_dir, "orders") if raw is None else raw
    raw = _days(raw, since - timedelta(days=1) if since else None, until)
    moment = F.col("o_orderdate") + F.make_dt_interval(secs=key % 86400)
    if since is not None:
        raw = raw.filter(F.to_date(moment) >= F.lit(since))
    if until is not None:
        raw = raw.filter(F.to_date(moment) <= F.lit(until))
    return raw.select(
        key.alias("order_id"),
        (F.col("o_custkey") % trucks).alias("truck_id"),
        F.when(key % 50 == 0, F.lit(None).cast("bigint")).otherwise(F.col("o_custkey")).alias("customer_id"),
        moment.alias("order_ts"),
        dec("o_totalprice").alias("order_total"),
    )


def header_details() -> dict[str, Column]:
    """Columns of a header that follow from its key and total."""
    key = F.col("order_id")
    return {
        "location_id": (key % 25).cast("double"),
        "order_amount": F.col("order_total"),
        "order_tax_amount": F.when(key % 7 != 0, text_id(key % 40)),
        "order_discount_amount": text_id(key % 101),
    }


def order_header(spark, sf_dir, raw: DataFrame | None = None, since: date | None = None, until: date | None = None):
    """Order headers of the orders table, or of ``raw`` rows of it such as a micro-batch."""
    names = "order_id truck_id location_id customer_id order_ts order_amount order_tax_amount order_discount_amount order_total".split()
    return header_rows(spark, sf_dir, raw, since, until).withColumns(header_details()).select(*names)


def landing_header(spark, sf_dir, since: date | None = None):
    """Headers as delivered: pending urgent orders arrive twice, a few totals are negative or missing.

    ``since`` only narrows the scan: all rows whose ``order_ts`` is on or after that day are there.
    """
    key = F.col("o_orderkey")
    again = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "P")
    shifts = F.when(again, F.array(F.lit(0), F.lit(1_000_000_000))).otherwise(F.array(F.lit(0)))
    total = dec("o_totalprice")
    raw = _days(table(spark, sf_dir, "orders"), since - timedelta(days=1) if since else None, None)
    return (
        raw.select("*", F.explode(shifts).alias("shift"))
        .select(
            (key + F.col("shift")).alias("order_id"),
            F.when(key % 50 != 0, F.col("o_custkey")).alias("customer_id"),
            (F.col("o_orderdate") + F.make_dt_interval(secs=key % 86400)).alias("order_ts"),
            F.when(key % 991 != 0, total).alias("order_amount"),
            F.when(key % 997 == 0, -total).otherwise(total).alias("order_total"),
        )
    )


def order_detail(spark, sf_dir, raw: DataFrame | None = None):
    return order_items(spark, sf_dir, raw).select(
        F.col("order_item_id").alias("order_detail_id"),
        "order_id",
        "line_number",
        F.col("product_id").alias("menu_item_id"),
        "quantity",
        "unit_price",
        line_price().alias("price"),
    )


def _nations(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey)


def truck_details() -> dict[str, Column]:
    """Columns of a truck that follow from its key, its ``s_nationkey`` and the names of its nation."""
    key = F.col("truck_id")
    return {
        "menu_type_id": (key % 6).cast("int"),
        "primary_city": F.concat(F.lit("CITY_"), text_id("s_nationkey")),
        "region": F.col("r_name"),
        "country": F.col("n_name"),
        "franchise_flag": (key % 20 < 10).cast("int"),
        "franchise_id": key % 20,
    }


def truck(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").withColumn("truck_id", F.col("s_suppkey"))
    n = _nations(spark, sf_dir)
    details = truck_details()
    return s.join(n, s.s_nationkey == n.n_nationkey).withColumns(details).select("truck_id", *details)


def franchise(spark, sf_dir):
    return (
        table(spark, sf_dir, "supplier")
        .groupBy((F.col("s_suppkey") % 20).alias("franchise_id"))
        .agg(F.min("s_name").alias("first_name"), F.max("s_name").alias("last_name"))
    )


def location(spark, sf_dir):
    return _nations(spark, sf_dir).select(
        F.col("n_nationkey").cast("bigint").alias("location_id"),
        F.concat(F.lit("CITY_"), text_id("n_nationkey")).alias("city"),
        F.col("r_name").alias("region"),
        F.concat(F.lit("N"), text_id("n_nationkey")).alias("iso_country_code"),
        F.col("n_name").alias("country"),
    )


def truck_brand(menu_type: str) -> Column:
    return F.concat(F.lit("Truck "), F.initcap(menu_type))


def menu(spark, sf_dir):
    size, price = F.col("p_size"), dec("p_retailprice", 10, 2)
    metrics = F.format_string(
        '{"menu_item_health_metrics":[{"metric":"calories","value":%d},'
        '{"metric":"fat","value":%d},{"metric":"sodium","value":%d}]}',
        size * 10,
        size,
        size * 2,
    )
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("menu_item_id"),
        lookup(F.col("p_type"), MENU_TYPES).alias("menu_type_id"),
        F.col("p_type").alias("menu_type"),
        truck_brand("p_type").alias("truck_brand_name"),
        F.col("p_name").alias("menu_item_name"),
        dec(price * F.lit(Decimal("0.04")) * size.cast("decimal(7,0)")).alias("cost_of_goods_usd"),
        dec(price).alias("sale_price_usd"),
        metrics.alias("health_metrics"),
    )


def member_details(key: Column) -> dict[str, Column]:
    """Columns of a member that follow from the customer's key."""
    return {
        "last_name": F.concat(F.lit("Family"), text_id(key % 500)),
        "e_mail": F.when(key % 89 == 0, F.lit(None).cast("string")).when(key % 83 == 0, "").otherwise(_email(key)),
        "phone_number": _phone(key),
        "children_count": text_id(key % 4),
        "gender": F.when(key % 2 == 0, "Female").otherwise("Male"),
        "marital_status": F.when(key % 3 == 0, "Single").otherwise("Married"),
    }


def customer_loyalty(spark, sf_dir):
    key = F.col("customer_id")
    details = {name: col.alias(name) for name, col in member_details(key).items()}
    return customers(spark, sf_dir).select(
        key,
        F.col("customer_name").alias("first_name"),
        details["last_name"],
        "city",
        "country",
        details["e_mail"],
        details["phone_number"],
        details["children_count"],
        details["gender"],
        details["marital_status"],
        F.col("signup_date").alias("sign_up_date"),
    )


def history_day(spark, sf_dir):
    """One weather row per day and postal code; 1997-02-01 is the first day."""
    value = dec("value", 10, 2)
    offset = F.datediff(F.to_date("ts"), F.lit(date(2024, 1, 1)))
    return (
        table(spark, sf_dir, "events")
        .groupBy(
            F.date_add(F.lit(date(1997, 2, 1)), offset).alias("date_valid_std"),
            text_id(F.col("user_id") % 50).alias("postal_code"),
            F.concat(F.lit("NATION_"), text_id(F.col("user_id") % 25)).alias("country"),
        )
        .agg(
            (F.max(value) + F.lit(Decimal("20.00"))).cast("decimal(12,2)").alias("avg_temperature_f"),
            dec(F.sum(value) * F.lit(Decimal("0.01"))).alias("tot_precipitation_in"),
            F.max(value).alias("max_wind_mph"),
        )
    )


def postal_codes(spark, sf_dir):
    return (
        table(spark, sf_dir, "events")
        .select(
            text_id(F.col("user_id") % 50).alias("postal_code"),
            F.concat(F.lit("NATION_"), text_id(F.col("user_id") % 25)).alias("country"),
            F.concat(F.lit("CITY_"), text_id(F.col("user_id") % 25)).alias("city_name"),
        )
        .distinct()
    )


# --- change log and telemetry ---------------------------------------------


def payload() -> Column:
    return F.regexp_extract("props", r"(\d+)", 1).cast("bigint")


def change_log(spark, sf_dir):
    """Row changes keyed by user: an update is a DELETE then an INSERT at one commit."""
    kind = F.col("event_type")

    def change(action: str, update: bool, step: int) -> Column:
        return F.struct(
            F.lit(action).alias("action"), F.lit(update).alias("is_update"), F.lit(step).alias("step")
        )

    changes = (
        F.when(kind == "click", F.array(change("DELETE", True, 0), change("INSERT", True, 1)))
        .when(kind == "error", F.array(change("DELETE", False, 0)))
        .otherwise(F.array(change("INSERT", False, 1)))
    )
    return (
        table(spark, sf_dir, "events")
        .select("*", F.explode(changes).alias("c"))
        .select(
            F.col("user_id").alias("key"),
            F.col("ts").alias("commit_ts"),
            F.col("event_id").alias("commit_id"),
            F.col("c.step").alias("step"),
            F.col("c.action").alias("action"),
            F.col("c.is_update").alias("is_update"),
            payload().alias("payload"),
            F.col("event_type").alias("origin"),
        )
    )


def stage_events(spark, sf_dir):
    """Log and span rows of a job run."""
    kind = F.col("event_type")
    failed = kind == "error"
    return table(spark, sf_dir, "events").select(
        F.col("event_id"),
        F.col("ts").alias("event_timestamp"),
        F.when(kind.isin("view", "purchase"), "SPAN").otherwise("LOG").alias("record_type"),
        F.when(failed, "ERROR").when(kind == "click", "WARN").otherwise("INFO").alias("severity_level"),
        F.concat(F.lit("proc_"), text_id(F.col("user_id") % 5)).alias("procedure_name"),
        F.concat(text_id("user_id"), F.lit("-"), F.date_format("ts", "yyyyMMdd")).alias("trace_id"),
        F.concat(F.lit("step_"), text_id(F.col("user_id") % 5)).alias("process_step"),
        F.concat(kind, F.lit(" event")).alias("message"),
        F.col("props").alias("attributes"),
        failed.alias("error_flag"),
        F.when(failed, F.concat(F.lit("failed with code "), text_id(payload() % 10))).alias("error_message"),
        F.floor(F.col("value") * 10).cast("bigint").alias("execution_time_ms"),
        payload().alias("records_processed"),
    )


# Severity of each kind of event.
SEVERITY = {"error": "CRITICAL", "click": "ERROR", "purchase": "WARNING"}


def alerts(spark, sf_dir):
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("alert_id"),
        F.col("ts").alias("alert_time"),
        F.concat(F.lit("ALERT_"), F.upper(kind)).alias("alert_name"),
        lookup(kind, SEVERITY, "INFO").alias("severity"),
        F.concat(F.lit("CATEGORY_"), text_id(F.col("user_id") % 3)).alias("category"),
        F.concat(F.lit("found "), text_id(payload())).alias("message"),
        payload().alias("record_count"),
        F.concat(F.lit("table_"), text_id(F.col("user_id") % 7)).alias("affected_table"),
        (F.col("value") < 25).alias("resolved_flag"),
    )


# --- time series ----------------------------------------------------------


def wage_series(spark, sf_dir, since: date | None = None, until: date | None = None):
    """(variable, geo_id, date, value): one point per order, variable = priority."""
    return _days(table(spark, sf_dir, "orders"), since, until).select(
        F.col("o_orderpriority").alias("variable"),
        F.when(F.col("o_orderstatus") == "P", "country/CAN").otherwise("country/USA").alias("geo_id"),
        F.to_date("o_orderdate").alias("date"),
        dec("o_totalprice").alias("value"),
    )


def wage_attributes(spark, sf_dir):
    pri = F.col("o_orderpriority")
    return (
        table(spark, sf_dir, "orders")
        .select(pri.alias("variable"))
        .distinct()
        .withColumn(
            "variable_name",
            F.concat(
                F.col("variable"),
                F.when(F.col("variable").isin("1-URGENT", "2-HIGH"), " Annual Wages").otherwise(" hours worked"),
            ),
        )
    )


def price_series(spark, sf_dir, since: date | None = None, until: date | None = None):
    """One price point per line, variable = product number's type via the part table."""
    l = _days(table(spark, sf_dir, "lineitem"), since, until, "l_shipdate")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    return l.join(p, l.l_partkey == p.p_partkey).select(
        F.col("p_type").alias("variable"),
        F.when(F.col("l_returnflag") == "R", "country/CAN").otherwise("country/USA").alias("geo_id"),
        F.to_date("l_shipdate").alias("date"),
        dec("l_extendedprice").alias("value"),
    )


def price_attributes(spark, sf_dir):
    return (
        table(spark, sf_dir, "part")
        .select(F.col("p_type").alias("variable"))
        .distinct()
        .withColumn(
            "variable_name",
            F.concat(
                F.col("variable"),
                F.when(F.col("variable").isin("ECONOMY", "STANDARD"), " CPI index").otherwise(" list price"),
            ),
        )
    )
