"""Point columns, distance joins and grid aggregation."""

from __future__ import annotations

from pyspark.sql import functions as F

from larkspur import domain as D
from larkspur.functions import geo
from larkspur.operators.nearby import places_within
from larkspur.plans.aggregates import n_rows
from larkspur.registry import query


def _place(df, key: str, nation: str):
    lon = (F.col(key) % 360 - 180).cast("double")
    lat = (F.col(nation) * 6 - 75).cast("double")
    return df.select(F.col(key).alias("id"), lon.alias("lon"), lat.alias("lat"))


def customer_points(spark, sf):
    return _place(D.table(spark, sf, "customer"), "c_custkey", "c_nationkey")


def supplier_points(spark, sf):
    return _place(D.table(spark, sf, "supplier"), "s_suppkey", "s_nationkey")


CUSTOMER_SQL = "SELECT c_custkey AS id, CAST(c_custkey % 360 - 180 AS DOUBLE) AS lon, CAST(c_nationkey * 6 - 75 AS DOUBLE) AS lat FROM customer"
SUPPLIER_SQL = "SELECT s_suppkey AS id, CAST(s_suppkey % 360 - 180 AS DOUBLE) AS lon, CAST(s_nationkey * 6 - 75 AS DOUBLE) AS lat FROM supplier"


@query("geo_point_columns", f"SELECT id, lon AS x, lat AS y FROM ({CUSTOMER_SQL})")
def geo_point_columns(spark, sf):
    p = customer_points(spark, sf).select("id", geo.point(F.col("lon"), F.col("lat")).alias("p"))
    return p.select("id", F.col("p.lon").alias("x"), F.col("p.lat").alias("y"))


RADIUS_KM = 500


@query(
    "geo_distance_join",
    f"""WITH a AS (SELECT lon, lat, count(*) AS suppliers FROM ({SUPPLIER_SQL}) GROUP BY 1, 2), b AS (SELECT lon, lat, count(*) AS customers FROM ({CUSTOMER_SQL}) GROUP BY 1, 2),
d AS (SELECT a.*, b.customers, 2 * 6371000.0 * asin(sqrt(least(1.0, pow(sin(radians(b.lat - a.lat) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lon - a.lon) / 2), 2)))) AS m FROM a, b)
SELECT lon, lat, suppliers, CAST(sum(customers) AS BIGINT) AS customers_near, count(*) AS places_near, CAST(round(min(m) / 1000) AS BIGINT) AS nearest_km
FROM d WHERE m <= {RADIUS_KM}000 GROUP BY 1, 2, 3""",
)
def geo_distance_join(spark, sf, radius_km: float = RADIUS_KM):
    """Customers within a radius of each supplier place."""
    found = places_within(supplier_points(spark, sf), customer_points(spark, sf), radius_km)
    return found.select(
        "lon",
        "lat",
        F.col("own_points").alias("suppliers"),
        F.col("points_near").alias("customers_near"),
        "places_near",
        F.round(F.col("nearest_m") / 1000).cast("bigint").alias("nearest_km"),
    )


def _interleave_sql(length: int) -> str:
    total = 5 * length
    xb, yb = (total + 1) // 2, total // 2
    bits = []
    for i in range(total):
        src, left = ("x", xb - 1 - i // 2) if i % 2 == 0 else ("y", yb - 1 - i // 2)
        bits.append(f"((({src} >> {left}) & 1) << {total - 1 - i})")
    code = " | ".join(bits)
    letters = " || ".join(f"substring('{geo.BASE32}', CAST(((code >> {5 * (length - 1 - k)}) & 31) + 1 AS INTEGER), 1)" for k in range(length))
    return (
        f"SELECT id, {letters} AS hash FROM (SELECT id, {code} AS code FROM (SELECT id, CAST(least(floor((lon + 180) / (360.0 / {1 << xb})), {(1 << xb) - 1}) AS BIGINT) AS x, "
        f"CAST(least(floor((lat + 90) / (180.0 / {1 << yb})), {(1 << yb) - 1}) AS BIGINT) AS y FROM ({CUSTOMER_SQL})))"
    )


@query(
    "geo_grid_aggregate",
    f"SELECT substring(hash, 1, 2) AS parent_cell, count(*) AS points, count(DISTINCT hash) AS cells FROM ({_interleave_sql(4)}) GROUP BY 1",
)
def geo_grid_aggregate(spark, sf, length: int = 4, parent: int = 2):
    """Points per geohash cell, rolled up to the parent cell (a prefix)."""
    fine = (
        customer_points(spark, sf)
        .groupBy(geo.geohash(F.col("lon"), F.col("lat"), length).alias("cell"))
        .agg(n_rows("points"))
    )
    return fine.groupBy(F.substring("cell", 1, parent).alias("parent_cell")).agg(F.sum("points").alias("points"), n_rows("cells"))


@query(
    "geo_text_io",
    f"""SELECT id, 'POINT(' || CAST(lon AS BIGINT) || ' ' || CAST(lat AS BIGINT) || ')' AS wkt, lon AS lon_back,
  '{{"type":"Point","coordinates":[' || CAST(lon AS BIGINT) || '.0,' || CAST(lat AS BIGINT) || '.0]}}' AS geojson, lat AS lat_back FROM ({CUSTOMER_SQL})""",
)
def geo_text_io(spark, sf):
    base = customer_points(spark, sf).select("id", geo.point(F.col("lon"), F.col("lat")).alias("p"))
    text = base.select("id", geo.wkt(F.col("p")).alias("wkt"), geo.geojson(F.col("p")).alias("geojson"))
    back = geo.parse_wkt(F.col("wkt"))
    coordinates = F.from_json("geojson", "type string, coordinates array<double>")["coordinates"]
    return text.select("id", "wkt", back["lon"].alias("lon_back"), "geojson", coordinates[1].alias("lat_back"))
