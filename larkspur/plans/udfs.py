"""User-defined scalar and table functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from larkspur import domain as D
from larkspur.functions.units import fahrenheit_to_celsius, inch_to_millimeter, winsorize
from larkspur.registry import query


@query(
    "udf_sql_scalar",
    """SELECT postal_code, strftime(date_valid_std, '%Y-%m-%d') AS date, CAST(CAST(floor((avg_temperature_f - 32) * 5 * 1000000 / 9 / 100 + 0.5) AS BIGINT) * 0.0001 AS DOUBLE) AS celsius,
  CAST(CAST(CAST(tot_precipitation_in AS DECIMAL(18,4)) * 25.4 AS DECIMAL(35,4)) AS DOUBLE) AS millimeters FROM v_weather WHERE avg_temperature_f >= 32
UNION ALL SELECT postal_code, strftime(date_valid_std, '%Y-%m-%d'), CAST(-CAST(floor(-(avg_temperature_f - 32) * 5 * 1000000 / 9 / 100 + 0.5) AS BIGINT) * 0.0001 AS DOUBLE),
  CAST(CAST(CAST(tot_precipitation_in AS DECIMAL(18,4)) * 25.4 AS DECIMAL(35,4)) AS DOUBLE) FROM v_weather WHERE avg_temperature_f < 32""",
)
def udf_sql_scalar(spark, sf):
    return D.history_day(spark, sf).select(
        "postal_code",
        F.col("date_valid_std").alias("date"),
        fahrenheit_to_celsius(F.col("avg_temperature_f")).alias("celsius"),
        inch_to_millimeter(F.col("tot_precipitation_in")).alias("millimeters"),
    )


@query(
    "udf_sql_subquery",
    """SELECT menu_item_id, CAST((SELECT max(sale_price_usd) FROM v_menu) AS DOUBLE) AS max_price,
  CAST(CAST((SELECT max(sale_price_usd) FROM v_menu) * 1.35 AS DECIMAL(10,2)) AS DOUBLE) AS max_price_converted FROM v_menu""",
)
def udf_sql_subquery(spark, sf, rate: str = "1.35"):
    """A function over a subquery: the maximum is computed once and read as a scalar."""
    menu = D.menu(spark, sf)
    top = menu.agg(F.max("sale_price_usd")).scalar()
    return menu.select(
        "menu_item_id", top.cast("decimal(5,2)").alias("max_price"), (top * F.lit(rate).cast("decimal(4,2)")).cast("decimal(10,2)").alias("max_price_converted")
    )


@query("udf_python_scalar", "SELECT event_id, least(greatest(value, 5.0), 40.0) AS clamped FROM events")
def udf_python_scalar(spark, sf, upper: float = 40.0, lower: float = 5.0):
    """Built-ins instead of a Python function; the tests hold a pandas twin against it."""
    return D.table(spark, sf, "events").select("event_id", winsorize(F.col("value"), upper, lower).alias("clamped"))


def register_prices_above(spark, sf) -> None:
    """A SQL table function: ``SELECT * FROM menu_prices_above(940)``. Its body is inlined, so filters around it reach the scan."""
    D.menu(spark, sf).createOrReplaceTempView("menu_items")
    spark.sql(
        """CREATE OR REPLACE TEMPORARY FUNCTION menu_prices_above(floor_price DECIMAL(18,4))
        RETURNS TABLE (item STRING, price DECIMAL(18,4))
        RETURN SELECT menu_item_name, sale_price_usd FROM menu_items WHERE sale_price_usd > floor_price"""
    )


@query(
    "udtf_prices_above",
    "SELECT menu_item_name AS item, CAST(sale_price_usd AS DOUBLE) AS price FROM v_menu WHERE sale_price_usd > 940 AND menu_item_name ILIKE '%bolt%'",
)
def udtf_prices_above(spark, sf):
    register_prices_above(spark, sf)
    return spark.sql("SELECT item, price FROM menu_prices_above(940) WHERE item ILIKE '%BOLT%'")


@query(
    "udtf_token_rows",
    """SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS BIGINT) AS position, token FROM
(SELECT doc_id, i, w[i] AS token FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM
(SELECT doc_id, string_split(replace(text, chr(10), ' '), ' ') AS w FROM documents))) WHERE token <> ''""",
)
def udtf_token_rows(spark, sf):
    """One row per token of the whole text, with its place; no shuffle."""
    from larkspur.functions.dialect import tokens

    return D.table(spark, sf, "documents").select("doc_id", F.posexplode(tokens("text", " \n")).alias("position", "token"))


@query(
    "udtf_split_rows",
    """SELECT doc_id, token, count(*) AS n FROM (SELECT doc_id, unnest(string_split(replace(text, chr(10), ' '), ' ')) AS token FROM documents) WHERE token <> '' GROUP BY 1, 2""",
)
def udtf_split_rows(spark, sf):
    """One row per different token of each whole text with its count, all within the row: no token is shuffled."""
    from larkspur.functions.dialect import token_counts

    counted = D.table(spark, sf, "documents").select("doc_id", F.explode(token_counts("text", " \n")).alias("t"))
    return counted.select("doc_id", "t.token", "t.n")
