"""Grid joins against brute force, with poles and the date line."""

import math
import random

import pytest
from pyspark.sql import functions as F

from larkspur.functions import geo
from larkspur.operators.nearby import places_within


def haversine(a, b):
    la1, la2 = math.radians(a[1]), math.radians(b[1])
    h = math.sin((la2 - la1) / 2) ** 2 + math.cos(la1) * math.cos(la2) * math.sin(math.radians(b[0] - a[0]) / 2) ** 2
    return 2 * geo.EARTH_RADIUS_M * math.asin(math.sqrt(min(1.0, h)))


def points(n, seed):
    rnd = random.Random(seed)
    out = [(rnd.uniform(-180, 180), rnd.uniform(-90, 90)) for _ in range(n)]
    out += [(rnd.choice([-180.0, -179.9, 179.9]), rnd.uniform(-90, 90)) for _ in range(40)]
    out += [(rnd.uniform(-180, 180), rnd.choice([-89.9, -88.0, 87.0, 89.5, 90.0])) for _ in range(40)]
    return out + [(10.0, 50.0)] * 30  # one place with many points


@pytest.mark.parametrize("radius", [50.0, 900.0, 4000.0, 15000.0])
def test_within_radius(spark, radius):
    own, other = points(120, 1), points(200, 2)
    schema = "lon double, lat double"
    found = places_within(spark.createDataFrame(own, schema), spark.createDataFrame(other, schema), radius)
    got = {(r.lon, r.lat): r.points_near for r in found.collect()}
    want = {}
    for p in set(own):
        n = sum(haversine(p, q) <= radius * 1000 for q in other)
        if n:
            want[p] = n
    assert got == want


def test_geohash_known_cells(spark):
    df = spark.createDataFrame([(-5.6, 42.6), (0.0, 0.0), (179.99, 89.99), (-180.0, -90.0)], "lon double, lat double")
    got = [r[0] for r in df.select(geo.geohash(F.col("lon"), F.col("lat"), 5)).collect()]
    assert got == ["ezs42", "s0000", "zzzzz", "00000"]


def test_text_round_trip(spark):
    df = spark.createDataFrame([(-73.9, 40.7), (10.0, -5.0)], "lon double, lat double").select(geo.point(F.col("lon"), F.col("lat")).alias("p"))
    back = df.select(geo.wkt(F.col("p")).alias("t"), "p").select(geo.parse_wkt(F.col("t")).alias("q"), "p")
    assert back.filter(F.col("p") != F.col("q")).count() == 0
    assert spark.range(1).select(geo.parse_wkt(F.lit("LINE(1 2)")).alias("q")).first().q is None
