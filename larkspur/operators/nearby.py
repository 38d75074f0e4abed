"""Distance join of two sets of places on a sphere."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.functions import geo


class Grid:
    """Latitude bands at least one radius high, cut into longitude slots at least one radius wide.

    A degree of longitude shrinks towards the poles, so each band has its own number of
    slots; a band that touches a pole has one. Points within the radius of each other
    are in the same or a neighbouring band, and there in the same or a neighbouring
    slot, counted around the date line.
    """

    def __init__(self, radius_km: float):
        self.step = math.degrees(radius_km * 1000 / geo.EARTH_RADIUS_M) * 1.001

    def band(self, lat):
        return F.floor((lat + 90) / self.step)

    def slots(self, band):
        # the farthest latitude a pair with one point in this band can reach
        edge = F.greatest(F.abs(band * self.step - 90), F.abs((band + 1) * self.step - 90)) + self.step
        # widest longitude gap of two points one radius apart: asin(sin r / cos lat)
        ratio = F.lit(math.sin(math.radians(self.step))) / F.cos(F.radians(F.least(edge, F.lit(89.9))))
        width = F.when((edge < 89.9) & (ratio < 1), F.degrees(F.asin(F.least(ratio, F.lit(1.0))))).otherwise(F.lit(360.0))
        return F.greatest(F.floor(F.lit(360.0) / width), F.lit(1))

    def slot(self, lon, band):
        n = self.slots(band)
        return F.pmod(F.floor((lon + 180) / (F.lit(360.0) / n)), n)

    def near_slots(self, lon, band):
        n, s = self.slots(band), self.slot(lon, band)
        return F.array_distinct(F.array(F.pmod(s - 1, n), s, F.pmod(s + 1, n)))


def places_within(own: DataFrame, other: DataFrame, radius_km: float) -> DataFrame:
    """Points of ``other`` within the radius of each place of ``own``; both have (lon, lat).

    Points are counted per distinct place first, so a place that holds a third of all
    points meets its neighbours as one row. Only own places are copied to the
    neighbouring cells; the exact distance decides in the end. A skewed cell is split
    by AQE, and pairs are folded into one row per own place as they arise.
    """
    grid = Grid(radius_km)
    lon, lat = F.col("lon"), F.col("lat")
    near = other.groupBy("lon", "lat").agg(F.count(F.lit(1)).alias("points"))
    near = near.select(
        lon.alias("lon2"), lat.alias("lat2"), "points", grid.band(lat).alias("band"), grid.slot(lon, grid.band(lat)).alias("slot")
    )
    mine = own.groupBy("lon", "lat").agg(F.count(F.lit(1)).alias("own_points"))
    bands = F.array(*[grid.band(lat) + d for d in (-1, 0, 1)])
    spread = mine.select("*", F.explode(bands).alias("band"))
    spread = spread.select("*", F.explode(grid.near_slots(lon, F.col("band"))).alias("slot"))
    metres = geo.distance_m(lon, lat, F.col("lon2"), F.col("lat2"))
    return (
        spread.join(near, ["band", "slot"])
        .withColumn("m", metres)
        .filter(F.col("m") <= radius_km * 1000)
        .groupBy("lon", "lat", "own_points")
        .agg(F.sum("points").alias("points_near"), F.count(F.lit(1)).alias("places_near"), F.min("m").alias("nearest_m"))
    )
