"""Change data: differences, upserts, versioned dimensions, snapshots."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import functions as F

from larkspur import domain as D
from larkspur.operators import changes as C
from larkspur.operators import merge as M
from larkspur.operators.ordered import numbered
from larkspur.operators.refresh import summarise_sales
from larkspur.plans import datasets as P
from larkspur.plans.aggregates import n_rows
from larkspur.plans.joins import initial_customer_dim
from larkspur.registry import query
from larkspur.session import durable, scratch_dir
from larkspur.sources.partitioned import PartitionedTable
from larkspur.sources.versioned import VersionedTable

T1, T2 = datetime(2024, 1, 15), datetime(2024, 1, 30)
VALUES = ["payload", "origin"]


def _state_sql(ts: str) -> str:
    return f"""SELECT key, payload, origin FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY commit_ts DESC, commit_id DESC, step DESC) AS rn
FROM v_changes WHERE commit_ts <= TIMESTAMP '{ts}') WHERE rn = 1 AND action = 'INSERT'"""


DIFF_SQL = f"""WITH o AS ({_state_sql('2024-01-15')}), n AS ({_state_sql('2024-01-30')}),
j AS (SELECT coalesce(o.key, n.key) AS key, o.key IS NOT NULL AS had, n.key IS NOT NULL AS has, o.payload AS op, o.origin AS oo, n.payload AS np, n.origin AS no
  FROM o FULL OUTER JOIN n ON o.key = n.key)
SELECT key, 'INSERT' AS action, had AS is_update, sha256(CAST(key AS VARCHAR)) AS row_id, np AS payload, no AS origin FROM j
WHERE has AND (NOT had OR op IS DISTINCT FROM np OR oo IS DISTINCT FROM no)
UNION ALL SELECT key, 'DELETE', has, sha256(CAST(key AS VARCHAR)), op, oo FROM j WHERE had AND (NOT has OR op IS DISTINCT FROM np OR oo IS DISTINCT FROM no)"""


@query("change_log_diff", DIFF_SQL)
def change_log_diff(spark, sf):
    log = D.change_log(spark, sf)
    old = C.snapshot_as_of(log, "key", VALUES, T1)
    new = C.snapshot_as_of(log, "key", VALUES, T2)
    return C.diff_states(old, new, ["key"], VALUES)


@query(
    "change_net",
    """WITH e AS (SELECT key, arg_min(action, (commit_ts, commit_id, step)) AS f, arg_max(action, (commit_ts, commit_id, step)) AS l,
  arg_min(payload, (commit_ts, commit_id, step)) AS po, arg_max(payload, (commit_ts, commit_id, step)) AS pn,
  arg_min(origin, (commit_ts, commit_id, step)) AS oo, arg_max(origin, (commit_ts, commit_id, step)) AS onew FROM v_changes WHERE commit_ts > TIMESTAMP '2024-01-15' GROUP BY 1)
SELECT key, 'INSERT' AS action, f = 'DELETE' AS is_update, pn AS payload, onew AS origin FROM e WHERE l = 'INSERT'
UNION ALL SELECT key, 'DELETE', l = 'INSERT', po, oo FROM e WHERE f = 'DELETE'""",
)
def change_net(spark, sf, offset: datetime = T1):
    pending = D.change_log(spark, sf).filter(F.col("commit_ts") > F.lit(offset).cast("timestamp_ntz"))
    return C.net_changes(pending, "key", VALUES)


@query(
    "change_append_only",
    "SELECT key, commit_id, payload, origin FROM v_changes WHERE action = 'INSERT' AND NOT is_update",
)
def change_append_only(spark, sf):
    return C.append_only(D.change_log(spark, sf)).select("key", "commit_id", "payload", "origin")


@query("merge_upsert", P.DAILY_PLAIN_SQL)
def merge_upsert(spark, sf, cut: date = date(2001, 5, 31), overlap: date = date(2001, 5, 1)):
    """Stored summary up to ``cut``, merged with a later run that restates the last month and adds new days.

    It is stored by month, and the merge reads and writes only the months the later run has rows in.
    """
    table = PartitionedTable.scratch(spark, "daily-summary", "month", F.date_format("summary_date", "yyyy-MM"))
    dates = P.dim_date(spark, sf)
    # the first run knew the restated month only in part: its pending orders had not arrived
    first = P.fact_sales(spark, sf, until=cut)
    known = (F.col("order_status") != "PENDING") | (F.col("date_sk") < int(overlap.strftime("%Y%m%d")))
    table.write(summarise_sales(first.filter(known), dates))
    source = summarise_sales(P.fact_sales(spark, sf, since=overlap), dates)
    return table.merge(source, ["summary_date"])


AS_OF = D.AS_OF_ORDERS
CUSTOMER_ATTRIBUTES = ["customer_name", "email", "country", "city", "customer_segment"]


def _customers_now(spark, sf):
    """Current customers: big spenders have moved to the premium segment."""
    spend = (
        D.table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("customer_id")).agg(F.sum(D.dec("o_totalprice")).alias("spend"))
    )
    segment = F.when(F.col("spend") > 3_000_000, "PREMIUM").otherwise(F.col("customer_segment"))
    return (
        D.customers(spark, sf)
        .join(spend, "customer_id", "left")
        .withColumn("customer_segment", segment)
        .select("customer_id", *CUSTOMER_ATTRIBUTES)
    )


def _customer_dim_before(spark, sf):
    """Dimension as loaded on 1996-06-30."""
    return initial_customer_dim(spark, sf).filter(F.col("effective_date") < F.lit(date(1996, 7, 1)))


def apply_customer_changes(dim, now, as_of: date = AS_OF):
    current = dim.filter("is_current").select("customer_id", *CUSTOMER_ATTRIBUTES)
    log = C.diff_states(current, now, ["customer_id"], CUSTOMER_ATTRIBUTES)
    return M.scd2_apply(dim, log, "customer_id", "customer_sk", CUSTOMER_ATTRIBUTES, as_of)


@query(
    "scd2_customer",
    """WITH now AS (SELECT c.* REPLACE (CASE WHEN s.spend > 3000000 THEN 'PREMIUM' ELSE customer_segment END AS customer_segment), signup_date < DATE '1996-07-01' AS known,
  coalesce(s.spend > 3000000, FALSE) AS changed FROM v_customers c LEFT JOIN (SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(18,4))) AS spend FROM orders GROUP BY 1) s
  ON s.o_custkey = c.customer_id),
fresh AS (SELECT (SELECT max(customer_id) + 1 FROM v_customers WHERE signup_date < DATE '1996-07-01') + row_number() OVER (ORDER BY customer_id) AS customer_sk,
  customer_id, customer_segment FROM now WHERE NOT known OR changed)
SELECT customer_sk, customer_id, customer_segment, '2001-08-01' AS effective_date, '9999-12-31' AS end_date, TRUE AS is_current FROM fresh
UNION ALL SELECT c.customer_id + 1, c.customer_id, c.customer_segment, strftime(c.signup_date, '%Y-%m-%d'), CASE WHEN n.changed THEN '2001-07-31' ELSE '9999-12-31' END, NOT n.changed
FROM v_customers c JOIN now n USING (customer_id) WHERE n.known""",
)
def scd2_customer(spark, sf):
    dim = apply_customer_changes(_customer_dim_before(spark, sf), _customers_now(spark, sf))
    return dim.select("customer_sk", "customer_id", "customer_segment", "effective_date", "end_date", "is_current")


PRODUCT_ATTRIBUTES = ["product_name", "category", "subcategory", "brand", "unit_price", "cost_price"]


@query(
    "scd2_product",
    """WITH fresh AS (SELECT (SELECT max(product_id) + 1 FROM v_products WHERE stock_quantity > 50) + row_number() OVER (ORDER BY product_id) AS product_sk, product_id,
  CASE WHEN category = 'PROMO' THEN CAST(unit_price + 10 AS DECIMAL(8,2)) ELSE unit_price END AS unit_price FROM v_products WHERE stock_quantity <= 50 OR category = 'PROMO')
SELECT product_sk, product_id, CAST(unit_price AS DOUBLE) AS unit_price, '2001-08-01' AS effective_date, '9999-12-31' AS end_date, TRUE AS is_current FROM fresh
UNION ALL SELECT product_id + 1, product_id, CAST(unit_price AS DOUBLE), '1995-01-01', CASE WHEN category = 'PROMO' THEN '2001-07-31' ELSE '9999-12-31' END, category <> 'PROMO'
FROM v_products WHERE stock_quantity > 50""",
)
def scd2_product(spark, sf, as_of: date = AS_OF):
    known = D.products(spark, sf).filter("stock_quantity > 50").select("product_id")
    dim = P.initial_product_dim(spark, sf).join(known, "product_id", "left_semi")
    raised = F.when(F.col("category") == "PROMO", F.col("unit_price") + 10).otherwise(F.col("unit_price"))
    now = D.products(spark, sf).select("product_id", *PRODUCT_ATTRIBUTES).withColumn("unit_price", raised.cast("decimal(8,2)"))
    log = C.diff_states(
        dim.filter("is_current").select("product_id", *PRODUCT_ATTRIBUTES), now, ["product_id"], PRODUCT_ATTRIBUTES
    )
    out = M.scd2_apply(dim, log, "product_id", "product_sk", PRODUCT_ATTRIBUTES, as_of)
    return out.select("product_sk", "product_id", "unit_price", "effective_date", "end_date", "is_current")


@query(
    "scd2_initial_load",
    """SELECT CASE WHEN customer_segment = 'BUILDING' THEN customer_id + 1 ELSE (SELECT max(customer_id) + 1 FROM v_customers WHERE customer_segment = 'BUILDING') +
  row_number() OVER (PARTITION BY customer_segment = 'BUILDING' ORDER BY customer_id) END AS customer_sk, customer_id, strftime(signup_date, '%Y-%m-%d') AS effective_date, TRUE AS is_current FROM v_customers""",
)
def scd2_initial_load(spark, sf):
    """One segment is loaded already; loading all customers adds the others once, and a second run adds none."""
    cols = ["customer_sk", "customer_id", "customer_segment", "effective_date", "end_date", "is_current"]
    dim = initial_customer_dim(spark, sf).filter("customer_segment = 'BUILDING'").select(*cols)
    source = D.customers(spark, sf).select("customer_id", "customer_segment", "signup_date")
    loaded = M.initial_load(dim, source, "customer_id", "customer_sk", F.col("signup_date"))
    again = M.initial_load(loaded, source, "customer_id", "customer_sk", F.col("signup_date"))
    return again.select("customer_sk", "customer_id", "effective_date", "is_current")


@query(
    "surrogate_key",
    "SELECT customer_id, 2 + 10 * (row_number() OVER (ORDER BY customer_name DESC) - 1) AS sk FROM v_customers",
)
def surrogate_key(spark, sf, start: int = 2, step: int = 10):
    rows = D.customers(spark, sf).select("customer_id", "customer_name")
    return numbered(rows, [F.desc("customer_name")], "sk", start, step).drop("customer_name")


@query(
    "update_where",
    """SELECT order_id, CASE WHEN order_status = 'PENDING' AND order_date < DATE '1996-01-01' THEN 'CANCELLED' ELSE order_status END AS order_status,
  CAST(CASE WHEN order_status = 'PENDING' AND order_date < DATE '1996-01-01' THEN 0 ELSE shipping_cost END AS DOUBLE) AS shipping_cost FROM v_orders""",
)
def update_where(spark, sf):
    """The table lies by date, so the stale orders are in few files; only those are written again."""
    table = VersionedTable.scratch(spark, "orders")
    table.write(D.orders(spark, sf).repartitionByRange("order_date"))
    stale = (F.col("order_status") == "PENDING") & (F.col("order_date") < F.lit(date(1996, 1, 1)))
    values = {"order_status": F.lit("CANCELLED"), "shipping_cost": F.lit(0)}
    return table.rewrite(stale, lambda rows: M.update_where(rows, stale, values)).select("order_id", "order_status", "shipping_cost")


@query(
    "delete_where",
    "SELECT order_id, customer_id, CAST(order_amount AS DOUBLE) AS order_amount FROM v_landing WHERE NOT coalesce(customer_id > 500 AND order_amount > 100000, FALSE)",
)
def delete_where(spark, sf):
    table = VersionedTable.scratch(spark, "landing")
    table.write(D.landing_header(spark, sf).select("order_id", "customer_id", "order_amount").repartitionByRange("order_amount"))
    large = (F.col("customer_id") > 500) & (F.col("order_amount") > 100000)
    return table.rewrite(large, lambda rows: M.delete_where(rows, large))


@query(
    "delete_all",
    "SELECT 'before' AS state, count(*) AS n FROM v_landing UNION ALL SELECT 'after', 0 UNION ALL SELECT 'reloaded', count(*) FROM v_landing WHERE customer_id IS NOT NULL",
)
def delete_all(spark, sf):
    """A table emptied in one step keeps its schema and takes rows again."""
    path = scratch_dir(spark, "truncated")
    rows = D.landing_header(spark, sf).select("order_id", "customer_id")
    counts = []
    for state, kept in (("before", rows), ("after", rows.limit(0)), ("reloaded", rows.filter("customer_id IS NOT NULL"))):
        kept.write.mode("overwrite").parquet(path)
        stored = spark.read.schema(rows.schema).parquet(path).agg(n_rows())
        counts.append(durable(stored).withColumn("state", F.lit(state)))
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query(
    "retention_delete",
    "SELECT order_id, strftime(order_date, '%Y-%m-%d') AS order_date FROM v_orders WHERE order_date >= (SELECT max(order_date) - 180 FROM v_orders)",
)
def retention_delete(spark, sf, days: int = 180):
    """Months before the last one to keep are dropped as folders; only that one is written again."""
    month = F.date_format("order_date", "yyyy-MM")
    table = PartitionedTable.scratch(spark, "orders-retention", "month", month)
    stored = table.write(D.orders(spark, sf).select("order_id", "order_date"))
    cutoff = F.lit(stored.agg(F.date_sub(F.max("order_date"), days)).first()[0])
    return table.retain(F.col("order_date") >= cutoff, F.date_format(cutoff, "yyyy-MM"))


@query("snapshot_as_of", _state_sql("2024-01-15"))
def snapshot_as_of(spark, sf, ts: datetime = T1):
    return C.snapshot_as_of(D.change_log(spark, sf), "key", VALUES, ts)


@query(
    "bad_update_repair",
    f"SELECT key, CAST(payload + 100 AS BIGINT) AS bad_value, payload AS restored_value FROM ({_state_sql('2024-01-30')}) WHERE origin = 'view'",
)
def bad_update_repair(spark, sf):
    """Find the rows a wrong update touched and their values from before it."""
    table = VersionedTable.scratch(spark, "state")
    before = table.write(C.snapshot_as_of(D.change_log(spark, sf), "key", VALUES, T2))
    wrong = F.col("origin") == "view"
    after = table.rewrite(wrong, lambda rows: M.update_where(rows, wrong, {"payload": F.col("payload") + 100}))
    return C.changed_rows(table.read(1), after, "key", "payload")


@query(
    "retention_telemetry",
    """SELECT 'stage_events' AS table_name, count(*) AS rows_before, count(*) FILTER (event_timestamp >= TIMESTAMP '2024-01-31' - INTERVAL 20 DAY) AS rows_kept FROM v_stage_events
UNION ALL SELECT 'alerts', count(*), count(*) FILTER (NOT (resolved_flag AND alert_time < TIMESTAMP '2024-01-31' - INTERVAL 10 DAY)) FROM v_alerts""",
)
def retention_telemetry(spark, sf, as_of: datetime = datetime(2024, 1, 31), event_days: int = 20, alert_days: int = 10):
    """Clean-up rules: old events go, old alerts go once they are resolved."""

    def before(col, days):
        return F.col(col) < F.lit(as_of - timedelta(days=days)).cast("timestamp_ntz")

    rules = {
        "stage_events": (D.stage_events(spark, sf).select("event_id", "event_timestamp"), before("event_timestamp", event_days)),
        "alerts": (
            D.alerts(spark, sf).select("alert_id", "alert_time", "resolved_flag"),
            F.col("resolved_flag") & before("alert_time", alert_days),
        ),
    }
    out = []
    for name, (rows, old) in rules.items():
        table = VersionedTable.scratch(spark, name)
        stored = table.write(rows)
        kept = table.rewrite(old, lambda rows, old=old: M.delete_where(rows, old))
        counts = stored.agg(n_rows("rows_before")).select(F.lit(name).alias("table_name"), "rows_before")
        out.append(counts.withColumn("rows_kept", kept.agg(n_rows()).scalar()))
    return out[0].unionByName(out[1])


BACKLOG_SQL = """SELECT '{name}' AS stream_name, count(*) AS pending_changes, strftime(min({ts}), '%Y-%m-%d %H:%M:%S') AS earliest_change_timestamp,
  strftime(max({ts}), '%Y-%m-%d %H:%M:%S') AS latest_change_timestamp FROM {table} WHERE {ts} > TIMESTAMP '{since}'"""
# stream, table, time of a change, and how far its consumer has come
STREAMS = (
    ("order_header_stream", "orders", "o_orderdate", datetime(2001, 6, 1)),
    ("order_detail_stream", "lineitem", "l_shipdate", datetime(2001, 7, 1)),
    ("event_stream", "events", "ts", datetime(2024, 1, 20)),
    ("error_stream", "events", "ts", datetime(2030, 1, 1)),
)


@query("stream_backlogs", " UNION ALL ".join(BACKLOG_SQL.format(name=n, table=t, ts=c, since=s) for n, t, c, s in STREAMS))
def stream_backlogs(spark, sf, streams=STREAMS):
    """One row for each change stream, also where nothing is pending."""
    out = []
    for name, source, ts, offset in streams:
        pending = D.table(spark, sf, source).filter(F.col(ts) > F.lit(offset).cast("timestamp_ntz"))
        out.append(
            pending.agg(n_rows("pending_changes"), F.min(ts).alias("earliest_change_timestamp"), F.max(ts).alias("latest_change_timestamp")).withColumn(
                "stream_name", F.lit(name)
            )
        )
    return reduce(lambda a, b: a.unionByName(b), out)


@query(
    "stream_backlog",
    """SELECT origin AS stream_name, count(*) AS pending_changes, count(*) FILTER (action = 'INSERT') AS inserts, count(*) FILTER (action = 'DELETE') AS deletes,
  strftime(min(commit_ts), '%Y-%m-%d %H:%M:%S') AS earliest_change_timestamp, strftime(max(commit_ts), '%Y-%m-%d %H:%M:%S') AS latest_change_timestamp
FROM v_changes WHERE commit_ts > TIMESTAMP '2024-01-15' GROUP BY 1""",
)
def stream_backlog(spark, sf, offset: datetime = T1):
    return (
        D.change_log(spark, sf)
        .filter(F.col("commit_ts") > F.lit(offset).cast("timestamp_ntz"))
        .groupBy(F.col("origin").alias("stream_name"))
        .agg(
            n_rows("pending_changes"),
            F.count_if(F.col("action") == "INSERT").alias("inserts"),
            F.count_if(F.col("action") == "DELETE").alias("deletes"),
            F.min("commit_ts").alias("earliest_change_timestamp"),
            F.max("commit_ts").alias("latest_change_timestamp"),
        )
    )
