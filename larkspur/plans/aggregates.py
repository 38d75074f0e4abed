"""Grouped and global aggregates; every one combines on the map side before it shuffles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur import domain as D
from larkspur.operators.quantiles import exact_quantiles
from larkspur.registry import query



def n_rows(alias: str = "n"):
    return F.count(F.lit(1)).alias(alias)


@query(
    "agg_basic",
    """SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS units,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,4))) AS DOUBLE) AS gross, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,4))) AS DOUBLE) / count(*) AS avg_price,
  min(l_extendedprice) AS min_price, max(l_extendedprice) AS max_price FROM lineitem GROUP BY 1, 2""",
)
def agg_basic(spark, sf):
    price = D.dec("l_extendedprice")
    return (
        D.table(spark, sf, "lineitem")
        .groupBy("l_returnflag", "l_linestatus")
        .agg(
            n_rows(),
            F.sum(F.col("l_quantity").cast("bigint")).alias("units"),
            F.sum(price).alias("gross"),
            D.mean(price).alias("avg_price"),
            F.min("l_extendedprice").alias("min_price"),
            F.max("l_extendedprice").alias("max_price"),
        )
    )


@query(
    "agg_count_distinct",
    """SELECT l_returnflag, count(DISTINCT l_orderkey) AS orders, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS suppliers
FROM lineitem GROUP BY 1""",
)
def agg_count_distinct(spark, sf):
    return (
        D.table(spark, sf, "lineitem")
        .groupBy("l_returnflag")
        .agg(
            F.count_distinct("l_orderkey").alias("orders"),
            F.count_distinct("l_partkey").alias("parts"),
            F.count_distinct("l_suppkey").alias("suppliers"),
        )
    )


@query(
    "agg_conditional_sum",
    """SELECT product_id, CAST(coalesce(sum(CASE WHEN movement_type IN ('PURCHASE', 'RETURN') THEN quantity ELSE -quantity END), 0) AS BIGINT)
  AS net_movement FROM v_movements GROUP BY 1""",
)
def agg_conditional_sum(spark, sf):
    return D.inventory_movements(spark, sf).groupBy("product_id").agg(net_movement().alias("net_movement"))


def net_movement():
    qty = F.col("quantity")
    return F.coalesce(
        F.sum(
            F.when(F.col("movement_type").isin("PURCHASE", "RETURN"), qty)
            .when(F.col("movement_type").isin("SALE", "ADJUSTMENT"), -qty)
            .otherwise(0)
        ),
        F.lit(0),
    )


@query(
    "agg_conditional_avg",
    """SELECT CAST(year(date) AS BIGINT) AS year, CAST(sum(value) FILTER (variable_name ILIKE '%annual wages%') AS DOUBLE) /
  nullif(count(value) FILTER (variable_name ILIKE '%annual wages%'), 0) AS avg_wages FROM v_wages JOIN v_wage_attributes USING (variable) GROUP BY 1""",
)
def agg_conditional_avg(spark, sf):
    """Five hot variables: points are added up per variable and year before they meet its name."""
    points = D.wage_series(spark, sf).groupBy("variable", F.year("date").alias("year"))
    sums = points.agg(F.sum("value").alias("total"), F.count("value").alias("points"))
    wage = F.col("variable_name").ilike("%annual wages%")
    return (
        sums.join(D.wage_attributes(spark, sf), "variable")
        .groupBy("year")
        .agg(F.try_divide(F.sum(F.when(wage, F.col("total"))).cast("double"), F.sum(F.when(wage, F.col("points")))).alias("avg_wages"))
    )


@query(
    "agg_count_if",
    """SELECT origin, count(*) FILTER (action = 'INSERT') AS inserts, count(*) FILTER (action = 'DELETE') AS deletes FROM v_changes GROUP BY 1""",
)
def agg_count_if(spark, sf):
    return (
        D.change_log(spark, sf)
        .groupBy("origin")
        .agg(
            F.count_if(F.col("action") == "INSERT").alias("inserts"),
            F.count_if(F.col("action") == "DELETE").alias("deletes"),
        )
    )


@query(
    "agg_having",
    """SELECT line_number, count(*) AS duplicated, CAST(sum(cnt - 1) AS BIGINT) AS excess FROM
(SELECT order_id, line_number, count(*) AS cnt FROM v_items GROUP BY 1, 2 HAVING count(*) > 1) GROUP BY 1""",
)
def agg_having(spark, sf):
    return (
        D.order_items(spark, sf)
        .groupBy("order_id", "line_number")
        .agg(n_rows("cnt"))
        .filter("cnt > 1")
        .groupBy("line_number")
        .agg(n_rows("duplicated"), F.sum(F.col("cnt") - 1).alias("excess"))
    )


@query(
    "agg_safe_ratio",
    """SELECT product_id, CASE WHEN sum(-net_effect) > 0 THEN CAST(sum(net_effect) AS DOUBLE) / sum(-net_effect) ELSE 0 END AS in_out_ratio,
  CAST(sum(quantity) AS DOUBLE) / nullif(count(*) FILTER (movement_type = 'SALE'), 0) AS units_per_sale FROM
(SELECT *, CASE WHEN movement_type IN ('PURCHASE', 'RETURN') THEN quantity ELSE -quantity END AS net_effect FROM v_movements) GROUP BY 1""",
)
def agg_safe_ratio(spark, sf):
    sums = (
        D.inventory_movements(spark, sf)
        .groupBy("product_id")
        .agg(
            net_movement().alias("net"),
            F.sum("quantity").alias("units"),
            F.count_if(F.col("movement_type") == "SALE").alias("sales"),
        )
    )
    out = -F.col("net")
    return sums.select(
        "product_id",
        F.when(out > 0, F.col("net").cast("double") / out).otherwise(F.lit(0.0)).alias("in_out_ratio"),
        F.try_divide(F.col("units").cast("double"), F.nullif(F.col("sales"), F.lit(0))).alias("units_per_sale"),
    )


@query(
    "agg_listagg",
    """SELECT process_step, string_agg(DISTINCT error_message, '; ' ORDER BY error_message) AS messages FROM v_stage_events WHERE error_flag GROUP BY 1""",
)
def agg_listagg(spark, sf):
    return joined_texts(D.stage_events(spark, sf).filter("error_flag"), ["process_step"], "error_message", "messages")


def joined_texts(df, keys, col, alias, sep="; "):
    """LISTAGG(DISTINCT col): duplicates go before the values meet, so a group holds distinct values only."""
    return (
        df.select(*keys, col)
        .distinct()
        .groupBy(*keys)
        .agg(F.expr(f"listagg({col}, '{sep}') WITHIN GROUP (ORDER BY {col})").alias(alias))
    )


@query(
    "agg_array_distinct",
    """SELECT customer_id, array_to_string(list_sort(list(DISTINCT CAST(location_id AS BIGINT))), ',') AS locations FROM v_header
WHERE customer_id IS NOT NULL GROUP BY 1""",
)
def agg_array_distinct(spark, sf):
    return (
        D.order_header(spark, sf)
        .filter("customer_id IS NOT NULL")
        .groupBy("customer_id")
        .agg(F.sort_array(F.collect_set(F.col("location_id").cast("bigint"))).alias("locations"))
    )


@query(
    "agg_group_expr",
    """SELECT CAST(year(order_date) AS BIGINT) AS year, CAST(month(order_date) AS BIGINT) AS month, count(*) AS n, count(DISTINCT customer_id) AS customers
FROM v_orders GROUP BY 1, 2""",
)
def agg_group_expr(spark, sf):
    return (
        D.orders(spark, sf)
        .groupBy(F.year("order_date").alias("year"), F.month("order_date").alias("month"))
        .agg(n_rows(), F.count_distinct("customer_id").alias("customers"))
    )


@query(
    "agg_global",
    """SELECT strftime(min(order_date), '%Y-%m-%d') AS first_day, strftime(max(order_date), '%Y-%m-%d') AS last_day, count(*) AS n,
  count(DISTINCT order_date) AS days FROM v_orders""",
)
def agg_global(spark, sf):
    d = F.col("order_date")
    return D.orders(spark, sf).agg(
        F.min(d).alias("first_day"), F.max(d).alias("last_day"), n_rows(), F.count_distinct(d).alias("days")
    )


@query("agg_distinct_rows", "SELECT DISTINCT primary_city, region, country FROM v_truck")
def agg_distinct_rows(spark, sf):
    return D.truck(spark, sf).select("primary_city", "region", "country").distinct()


@query(
    "agg_zero_default",
    """SELECT c.customer_id, CAST(coalesce(sum(h.order_total), 0) AS DOUBLE) AS spend FROM v_customers c
LEFT JOIN v_header h ON c.customer_id = h.customer_id AND h.order_total > 400000 GROUP BY 1""",
)
def agg_zero_default(spark, sf):
    big = (
        D.order_header(spark, sf)
        .filter("customer_id IS NOT NULL AND order_total > 400000")
        .groupBy("customer_id")
        .agg(F.sum("order_total").alias("spend"))
    )
    return (
        D.customers(spark, sf)
        .select("customer_id")
        .join(big, "customer_id", "left")
        .withColumn("spend", F.zeroifnull("spend"))
    )


@query(
    "agg_of_agg",
    """SELECT count(*) AS days, CAST(sum(total) AS DOUBLE) AS total, CAST(max(total) AS DOUBLE) AS best_day, CAST(sum(n) AS BIGINT) AS orders FROM
(SELECT CAST(o_orderdate AS DATE) AS d, sum(CAST(o_totalprice AS DECIMAL(18,4))) AS total, count(*) AS n FROM orders GROUP BY 1)""",
)
def agg_of_agg(spark, sf):
    daily = (
        D.table(spark, sf, "orders")
        .groupBy(F.to_date("o_orderdate").alias("d"))
        .agg(F.sum(D.dec("o_totalprice")).alias("total"), n_rows())
    )
    return daily.agg(
        n_rows("days"), F.sum("total").alias("total"), F.max("total").alias("best_day"), F.sum("n").alias("orders")
    )


@query(
    "agg_severity_counts",
    """SELECT category, count(*) FILTER (severity = 'CRITICAL') AS critical, count(*) FILTER (severity = 'ERROR') AS errors,
  count(*) FILTER (severity = 'WARNING') AS warnings, count(*) FILTER (severity = 'INFO') AS infos FROM v_alerts GROUP BY 1""",
)
def agg_severity_counts(spark, sf):
    def level(name):
        return F.count_if(F.col("severity") == name)

    return (
        D.alerts(spark, sf)
        .groupBy("category")
        .agg(
            level("CRITICAL").alias("critical"),
            level("ERROR").alias("errors"),
            level("WARNING").alias("warnings"),
            level("INFO").alias("infos"),
        )
    )


def _describe_sql(col: str) -> str:
    return (
        f"SELECT '{col}' AS column_name, count({col}) AS n, round(avg({col}), 4) AS mean, round(stddev({col}), 4) AS stddev, "
        f"CAST(min({col}) AS DOUBLE) AS min, CAST(max({col}) AS DOUBLE) AS max FROM lineitem"
    )


DESCRIBED = "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax".split()


def numeric_columns(df) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


@query("agg_describe", " UNION ALL ".join(_describe_sql(c) for c in DESCRIBED))
def agg_describe(spark, sf):
    """count, mean, stddev, min, max of each numeric column, in one pass."""
    lines = D.table(spark, sf, "lineitem")
    per_column = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.count(c).alias("n"),
            F.round(F.avg(c), 4).alias("mean"),
            F.round(F.stddev(c), 4).alias("stddev"),
            F.min(c).cast("double").alias("min"),
            F.max(c).cast("double").alias("max"),
        )
        for c in numeric_columns(lines)
    ]
    return lines.agg(F.array(*per_column).alias("rows")).select(F.inline("rows"))


@query("agg_group_count", "SELECT label, count(*) AS n FROM (SELECT CAST(label AS BIGINT) AS label FROM embeddings) GROUP BY 1")
def agg_group_count(spark, sf):
    return D.table(spark, sf, "embeddings").groupBy("label").agg(n_rows())


@query(
    "agg_metric_rows",
    """SELECT 'orders_' || lower(order_status) AS metric_name, CAST(count(*) AS DOUBLE) AS metric_value, 'rows' AS metric_unit,
  '{"status":"' || order_status || '"}' AS dimensions FROM v_orders GROUP BY order_status
UNION ALL SELECT 'step_time', CAST(sum(execution_time_ms) AS DOUBLE) / count(*), 'ms', '{"step":"' || process_step || '"}' FROM v_stage_events GROUP BY process_step
UNION ALL SELECT 'open_alerts', CAST(count(*) AS DOUBLE), 'alerts', '{"severity":"' || severity || '"}' FROM v_alerts WHERE NOT resolved_flag GROUP BY severity""",
)
def agg_metric_rows(spark, sf):
    def rows(df, name, value, unit, **dims):
        tags = F.to_json(F.struct(*[F.col(v).alias(k) for k, v in dims.items()]))
        return df.select(
            name.alias("metric_name"),
            value.cast("double").alias("metric_value"),
            F.lit(unit).alias("metric_unit"),
            tags.alias("dimensions"),
        )

    by_status = D.orders(spark, sf).groupBy("order_status").agg(n_rows("v"))
    by_step = D.stage_events(spark, sf).groupBy("process_step").agg(D.mean("execution_time_ms").alias("v"))
    by_level = D.alerts(spark, sf).filter(~F.col("resolved_flag")).groupBy("severity").agg(n_rows("v"))
    status_name = F.concat(F.lit("orders_"), F.lower("order_status"))
    return reduce(
        lambda a, b: a.unionByName(b),
        [
            rows(by_status, status_name, F.col("v"), "rows", status="order_status"),
            rows(by_step, F.lit("step_time"), F.col("v"), "ms", step="process_step"),
            rows(by_level, F.lit("open_alerts"), F.col("v"), "alerts", severity="severity"),
        ],
    )


ALL_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@query(
    "agg_row_counts",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, 'raw' AS kind, count(*) AS n FROM {t}" for t in ALL_TABLES),
)
def agg_row_counts(spark, sf):
    counts = [
        D.table(spark, sf, t).agg(n_rows()).select(F.lit(t).alias("table_name"), F.lit("raw").alias("kind"), "n")
        for t in ALL_TABLES
    ]
    return reduce(lambda a, b: a.unionByName(b), counts)


@query(
    "agg_monthly",
    "SELECT strftime(order_ts, '%Y-%m') AS month, CAST(sum(order_total) AS DOUBLE) AS total FROM v_header GROUP BY 1",
)
def agg_monthly(spark, sf):
    return (
        D.order_header(spark, sf)
        .groupBy(F.date_format("order_ts", "yyyy-MM").alias("month"))
        .agg(F.sum("order_total").alias("total"))
    )


@query(
    "agg_histogram",
    """WITH b AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem)
SELECT CAST(least(floor((l_extendedprice - lo) * 20 / (hi - lo)), 19) + 1 AS BIGINT) AS bin, count(*) AS n FROM lineitem, b GROUP BY 1""",
)
def agg_histogram(spark, sf):
    return histogram(D.table(spark, sf, "lineitem"), "l_extendedprice", 20)


def histogram(df, col, bins: int):
    """Equal-width bins 1..bins; the maximum belongs to the last one, a constant column to the first."""
    x = F.col(col)
    bounds = df.agg(F.struct(F.min(x).alias("lo"), F.max(x).alias("hi"))).scalar()
    lo, width = bounds["lo"], bounds["hi"] - bounds["lo"]
    slot = F.when(width > 0, F.least(F.floor((x - lo) * bins / F.nullif(width, F.lit(0))), F.lit(bins - 1)) + 1).when(x.isNotNull(), 1)
    return df.groupBy(slot.cast("bigint").alias("bin")).agg(n_rows())


@query(
    "agg_linear_trend",
    """SELECT l_returnflag, round(regr_slope(l_extendedprice, l_quantity), 4) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 3) AS intercept,
  round(regr_r2(l_extendedprice, l_quantity), 6) AS r2, count(*) AS n FROM lineitem GROUP BY 1""",
)
def agg_linear_trend(spark, sf):
    y, x = F.col("l_extendedprice"), F.col("l_quantity")
    return (
        D.table(spark, sf, "lineitem")
        .groupBy("l_returnflag")
        .agg(
            F.round(F.regr_slope(y, x), 4).alias("slope"),
            F.round(F.regr_intercept(y, x), 3).alias("intercept"),
            F.round(F.regr_r2(y, x), 6).alias("r2"),
            n_rows(),
        )
    )


@query(
    "agg_first_last_growth",
    """WITH m AS (SELECT o_orderpriority AS variable, strftime(o_orderdate, '%Y-%m') AS month, sum(CAST(o_totalprice AS DECIMAL(18,4))) AS total FROM orders GROUP BY 1, 2),
g AS (SELECT variable, CAST(min_by(total, month) AS DOUBLE) AS first_total, CAST(max_by(total, month) AS DOUBLE) AS last_total FROM m GROUP BY 1)
SELECT *, (last_total - first_total) / first_total AS growth FROM g""",
)
def agg_first_last_growth(spark, sf):
    monthly = (
        D.table(spark, sf, "orders")
        .groupBy(F.col("o_orderpriority").alias("variable"), F.date_format("o_orderdate", "yyyy-MM").alias("month"))
        .agg(F.sum(D.dec("o_totalprice")).cast("double").alias("total"))
    )
    ends = monthly.groupBy("variable").agg(
        F.min_by("total", "month").alias("first_total"), F.max_by("total", "month").alias("last_total")
    )
    return ends.withColumn("growth", F.try_divide(F.col("last_total") - F.col("first_total"), F.col("first_total")))


@query(
    "agg_kpi",
    """SELECT CAST(sum(CAST(value AS DECIMAL(18,4))) AS DOUBLE) AS total, CAST(sum(CAST(value AS DECIMAL(18,4))) AS DOUBLE) / count(*) AS mean,
  CAST(sum(records_processed) AS BIGINT) AS records, max(value) AS peak FROM events JOIN v_stage_events USING (event_id)""",
)
def agg_kpi(spark, sf):
    value = D.dec("value")
    return D.table(spark, sf, "events").agg(
        F.sum(value).alias("total"),
        D.mean(value).alias("mean"),
        F.sum(D.payload()).alias("records"),
        F.max("value").alias("peak"),
    )


@query(
    "agg_unpivot",
    """SELECT strftime(date_valid_std, '%Y-%m-%d') AS date, measure, CAST(max(value) AS DOUBLE) AS value FROM (
SELECT date_valid_std, 'Temperature (F)' AS measure, CAST(avg_temperature_f AS DECIMAL(18,4)) AS value FROM v_weather
UNION ALL SELECT date_valid_std, 'Precipitation (in)', tot_precipitation_in FROM v_weather
UNION ALL SELECT date_valid_std, 'Wind (mph)', CAST(max_wind_mph AS DECIMAL(18,4)) FROM v_weather) GROUP BY 1, 2""",
)
def agg_unpivot(spark, sf):
    daily = (
        D.history_day(spark, sf)
        .groupBy(F.col("date_valid_std").alias("date"))
        .agg(
            F.max(D.dec("avg_temperature_f")).alias("Temperature (F)"),
            F.max(D.dec("tot_precipitation_in")).alias("Precipitation (in)"),
            F.max(D.dec("max_wind_mph")).alias("Wind (mph)"),
        )
    )
    return daily.unpivot(["date"], ["Temperature (F)", "Precipitation (in)", "Wind (mph)"], "measure", "value")


# --- the aggregate-function families --------------------------------------

KEYS = ("l_returnflag", "l_linestatus")


def _lines(spark, sf):
    return D.table(spark, sf, "lineitem").groupBy(*KEYS)


@query(
    "aggf_basic",
    """SELECT l_returnflag, l_linestatus, count(*) AS n_star, count(1) AS n_one, count(DISTINCT l_suppkey) AS n_distinct,
  CAST(sum(l_partkey) AS BIGINT) AS total, CAST(sum(l_partkey) AS DOUBLE) / count(*) AS mean, min(l_shipdate)::VARCHAR AS first, max(l_partkey) AS last,
  any_value(l_returnflag) AS any_flag FROM lineitem GROUP BY 1, 2""",
)
def aggf_basic(spark, sf):
    return _lines(spark, sf).agg(
        n_rows("n_star"),
        F.count(F.lit(1)).alias("n_one"),
        F.count_distinct("l_suppkey").alias("n_distinct"),
        F.sum("l_partkey").alias("total"),
        D.mean("l_partkey").alias("mean"),
        F.min("l_shipdate").alias("first"),
        F.max("l_partkey").alias("last"),
        F.any_value("l_returnflag").alias("any_flag"),
    )


@query(
    "aggf_spread",
    """SELECT l_returnflag, l_linestatus, round(stddev(l_quantity), 6) AS sd, round(stddev_pop(l_quantity), 6) AS sd_pop,
  round(stddev_samp(l_quantity), 6) AS sd_samp, round(variance(l_quantity), 6) AS var, round(var_pop(l_quantity), 6) AS var_pop,
  round(var_samp(l_quantity), 6) AS var_samp FROM lineitem GROUP BY 1, 2""",
)
def aggf_spread(spark, sf):
    forms = {
        "sd": F.stddev,
        "sd_pop": F.stddev_pop,
        "sd_samp": F.stddev_samp,
        "var": F.variance,
        "var_pop": F.var_pop,
        "var_samp": F.var_samp,
    }
    return _lines(spark, sf).agg(*[F.round(fn("l_quantity"), 6).alias(name) for name, fn in forms.items()])


@query(
    "aggf_pairs",
    """SELECT l_returnflag, l_linestatus, round(corr(l_quantity, l_extendedprice), 8) AS corr, round(covar_pop(l_quantity, l_extendedprice), 3) AS covar_pop,
  round(covar_samp(l_quantity, l_extendedprice), 3) AS covar_samp, count(CASE WHEN l_returnflag <> 'R' THEN l_quantity END) AS valx_n,
  count(CASE WHEN l_returnflag <> 'R' THEN l_linenumber END) AS valy_n FROM lineitem GROUP BY 1, 2""",
)
def aggf_pairs(spark, sf):
    from larkspur.functions.dialect import regr_valx, regr_valy

    q, p = F.col("l_quantity"), F.col("l_extendedprice")
    known = F.when(F.col("l_returnflag") != "R", F.col("l_linenumber"))
    return _lines(spark, sf).agg(
        F.round(F.corr(q, p), 8).alias("corr"),
        F.round(F.covar_pop(q, p), 3).alias("covar_pop"),
        F.round(F.covar_samp(q, p), 3).alias("covar_samp"),
        F.count(regr_valx(known, q)).alias("valx_n"),
        F.count(regr_valy(known, q)).alias("valy_n"),
    )


@query(
    "aggf_shape",
    """SELECT l_returnflag, l_linestatus, round(kurtosis(l_quantity), 6) AS kurtosis, round(skewness(l_quantity), 6) AS skew FROM lineitem GROUP BY 1, 2""",
)
def aggf_shape(spark, sf):
    from larkspur.functions.dialect import sample_kurtosis, sample_skew

    return _lines(spark, sf).agg(
        F.round(sample_kurtosis("l_quantity"), 6).alias("kurtosis"), F.round(sample_skew("l_quantity"), 6).alias("skew")
    )


@query(
    "aggf_quantile",
    """WITH f AS (SELECT l_returnflag, l_linestatus, l_quantity, count(*) AS c FROM lineitem GROUP BY 1, 2, 3),
m AS (SELECT l_returnflag, l_linestatus, min(l_quantity) AS mode FROM f WHERE (l_returnflag, l_linestatus, c) IN
  (SELECT (l_returnflag, l_linestatus, max(c)) FROM f GROUP BY l_returnflag, l_linestatus) GROUP BY 1, 2)
SELECT l_returnflag, l_linestatus, median(l_quantity) AS median, quantile_cont(l_quantity, 0.9) AS p90_cont, quantile_disc(l_quantity, 0.9) AS p90_disc,
  any_value(mode) AS mode FROM lineitem JOIN m USING (l_returnflag, l_linestatus) GROUP BY 1, 2""",
)
def aggf_quantile(spark, sf):
    """Counts per value instead of buffers of whole groups: a group may hold any share of the rows."""
    return exact_quantiles(D.table(spark, sf, "lineitem"), KEYS, "l_quantity", {"median": 0.5, "p90_cont": 0.9}, {"p90_disc": 0.9}, "mode")


@query("aggf_approx")
def aggf_approx(spark, sf):
    return _lines(spark, sf).agg(
        F.approx_count_distinct("l_orderkey", 0.02).alias("orders"),
        F.approx_percentile("l_extendedprice", 0.5, 10000).alias("median_price"),
        F.to_json(F.expr("approx_top_k(l_linenumber, 3)")).alias("top_lines"),
    )


@query(
    "aggf_collect",
    """WITH d AS (SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY 1, 2)
SELECT p_brand, string_agg(p_type, '|' ORDER BY p_type) AS types, array_to_string(list(n ORDER BY p_type), ',') AS counts,
  '{' || string_agg('"' || p_type || '":' || n, ',' ORDER BY p_type) || '}' AS type_counts FROM d GROUP BY 1""",
)
def aggf_collect(spark, sf):
    """Values are counted per (brand, type) first, so a group collects distinct types only."""
    pairs = D.table(spark, sf, "part").groupBy("p_brand", "p_type").agg(n_rows())
    entries = F.sort_array(F.array_agg(F.struct("p_type", "n")))
    return pairs.groupBy("p_brand").agg(
        F.expr("listagg(p_type, '|') WITHIN GROUP (ORDER BY p_type)").alias("types"),
        F.transform(entries, lambda e: e["n"]).alias("counts"),
        F.to_json(F.map_from_entries(entries)).alias("type_counts"),
    )


@query(
    "aggf_bool_bit",
    """SELECT p_brand, bool_and(p_size > 1) AS all_big, bool_or(p_size > 49) AS any_huge, count(*) FILTER (p_size = 50) = 1 AS one_max,
  CAST(bit_and(p_size) AS BIGINT) AS b_and, CAST(bit_or(p_size) AS BIGINT) AS b_or, CAST(bit_xor(p_size) AS BIGINT) AS b_xor FROM part GROUP BY 1""",
)
def aggf_bool_bit(spark, sf):
    size = F.col("p_size")
    return (
        D.table(spark, sf, "part")
        .groupBy("p_brand")
        .agg(
            F.bool_and(size > 1).alias("all_big"),
            F.bool_or(size > 49).alias("any_huge"),
            (F.count_if(size == 50) == 1).alias("one_max"),
            F.bit_and(size).alias("b_and"),
            F.bit_or(size).alias("b_or"),
            F.bit_xor(size).alias("b_xor"),
        )
    )
