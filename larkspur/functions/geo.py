"""Points on a sphere as column expressions: struct(lon, lat), geohash cells, distances."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6371000.0
# The geohash alphabet.
BASE32 = "0123456789bcdefghjkmnpqrstuvwxyz"


def point(lon: Column, lat: Column) -> Column:
    return F.struct(lon.cast("double").alias("lon"), lat.cast("double").alias("lat"))


def distance_m(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Great-circle distance in metres (haversine)."""
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    a = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    return F.asin(F.sqrt(F.least(a, F.lit(1.0)))) * (2 * EARTH_RADIUS_M)


def cell(value: Column, low: float, span: float, bits: int) -> Column:
    """Index of the value among 2**bits equal slices of [low, low + span)."""
    slots = 1 << bits
    return F.least(F.floor((value - low) / F.lit(span / slots)), F.lit(slots - 1)).cast("bigint")


def geohash(lon: Column, lat: Column, length: int) -> Column:
    """Interleave longitude and latitude bits and spell them in base 32."""
    total = 5 * length
    lon_bits, lat_bits = (total + 1) // 2, total // 2
    x, y = cell(lon, -180.0, 360.0, lon_bits), cell(lat, -90.0, 180.0, lat_bits)
    code = F.lit(0).cast("bigint")
    for i in range(total):
        source, left = (x, lon_bits - 1 - i // 2) if i % 2 == 0 else (y, lat_bits - 1 - i // 2)
        code = F.shiftleft(code, 1).bitwiseOR(F.shiftright(source, left).bitwiseAND(1))
    letters = [
        F.substring(F.lit(BASE32), (F.shiftright(code, 5 * (length - 1 - k)).bitwiseAND(31) + 1).cast("int"), F.lit(1))
        for k in range(length)
    ]
    return F.concat(*letters)


def wkt(p: Column) -> Column:
    return F.concat(F.lit("POINT("), _number(p["lon"]), F.lit(" "), _number(p["lat"]), F.lit(")"))


def _number(x: Column) -> Column:
    """Shortest text: whole numbers without a fraction."""
    return F.when(x == F.floor(x), F.floor(x).cast("string")).otherwise(x.cast("string"))


def parse_wkt(text: Column) -> Column:
    """Point from text, null if the text is not a point."""
    pattern = r"^\s*POINT\s*\(\s*([-+0-9.eE]+)\s+([-+0-9.eE]+)\s*\)\s*$"
    lon = F.regexp_extract(text, pattern, 1).try_cast("double")
    lat = F.regexp_extract(text, pattern, 2).try_cast("double")
    return F.when(lon.isNotNull() & lat.isNotNull(), point(lon, lat))


def geojson(p: Column) -> Column:
    return F.to_json(F.struct(F.lit("Point").alias("type"), F.array(p["lon"], p["lat"]).alias("coordinates")))
