"""Traps where the warehouse function and Spark's function of that name differ."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from larkspur.functions import dialect as X
from larkspur.functions.units import fahrenheit_to_celsius, inch_to_millimeter, round_half_up, winsorize


def value(spark, col):
    return spark.range(1).select(col.alias("x")).first()[0]


def lit(v):
    return F.lit(v)


CASES = [
    ("split on a dot", lambda: X.split_text(lit("a.b"), "."), ["a", "b"]),
    ("whole text must match", lambda: X.regexp_like(lit("xabcx"), "abc"), False),
    ("alternation is grouped", lambda: X.regexp_like(lit("abz"), "ab|cz"), False),
    ("ltrim characters", lambda: X.ltrim_chars(lit("##a#"), "#"), "a#"),
    ("rtrim characters", lambda: X.rtrim_chars(lit("#a##"), "#"), "#a"),
    ("charindex absent", lambda: X.charindex("z", lit("abc")), 0),
    ("strtok skips empty", lambda: X.strtok(lit("a..b"), ".", 2), "b"),
    ("strtok past the end", lambda: X.strtok(lit("a.b"), ".", 3), None),
    ("strtok several delimiters", lambda: X.tokens(lit("a@b.c-d"), "@.-"), ["a", "b", "c", "d"]),
    ("truncate negative", lambda: X.truncate(lit(Decimal("-1.29")), 1), -1.2),
    ("div0", lambda: X.div0(lit(5.0), lit(0)), 0),
    ("div0 null divisor", lambda: X.div0(lit(5.0), lit(None).cast("int")), None),
    ("div0null null divisor", lambda: X.div0null(lit(5.0), lit(None).cast("int")), 0),
    ("greatest with null", lambda: X.greatest_or_null(lit(1), lit(None).cast("int")), None),
    ("cast rounds", lambda: X.round_to_int(lit(Decimal("123.956"))), 124),
    ("month boundary", lambda: X.datediff("month", lit(date(2024, 1, 31)), lit(date(2024, 2, 1))), 1),
    ("year boundary", lambda: X.datediff("year", lit(date(2023, 12, 31)), lit(date(2024, 1, 1))), 1),
    ("week boundary", lambda: X.datediff("week", lit(date(2024, 1, 7)), lit(date(2024, 1, 8))), 1),
    ("sunday is 0", lambda: X.dayofweek0(lit(date(2024, 1, 7))), 0),
    ("iso sunday is 7", lambda: X.dayofweek_iso(lit(date(2024, 1, 7))), 7),
    ("previous day skips today", lambda: X.previous_day(lit(date(2024, 1, 8)), "MON"), date(2024, 1, 1)),
    ("last day of quarter", lambda: X.last_day(lit(date(2024, 2, 3)), "quarter"), date(2024, 3, 31)),
    ("slice is zero-based", lambda: X.array_slice(F.array(*map(lit, [1, 2, 3, 4])), 1, 3), [2, 3]),
    ("position is zero-based", lambda: X.array_position(lit(3), F.array(*map(lit, [1, 2, 3]))), 2),
    ("position absent", lambda: X.array_position(lit(9), F.array(*map(lit, [1, 2, 3]))), None),
    ("multiset intersection", lambda: X.array_intersection(F.array(*map(lit, [1, 1, 1, 2])), F.array(*map(lit, [1, 1, 3]))), [1, 1]),
    ("multiset except", lambda: X.array_except(F.array(*map(lit, [1, 1, 1, 2])), F.array(*map(lit, [1, 1, 3]))), [1, 2]),
    ("range is end-exclusive", lambda: X.array_range(lit(1).cast("bigint"), lit(4).cast("bigint")), [1, 2, 3]),
    ("empty range", lambda: X.array_range(lit(1).cast("bigint"), lit(1).cast("bigint")), []),
    ("json ok", lambda: X.check_json(lit('{"a":[1,2]}')), None),
    ("json trailing text", lambda: X.check_json(lit('{"a":1}}')), "invalid"),
    ("json two values", lambda: X.check_json(lit("1,2")), "invalid"),
    ("json closes early", lambda: X.check_json(lit("1],[2")), "invalid"),
    ("json null input", lambda: X.check_json(lit(None).cast("string")), None),
    ("insert with update", lambda: X.object_insert(F.create_map(lit("a"), lit(1)), "a", lit(2), update=True), {"a": 2}),
    ("clamp", lambda: winsorize(lit(99.0), 40.0, 5.0), 40.0),
    ("celsius", lambda: fahrenheit_to_celsius(lit(Decimal("32.00"))), Decimal("0.0000")),
    ("celsius exact ratio", lambda: fahrenheit_to_celsius(lit(Decimal("33.00"))), Decimal("0.5556")),
    ("millimetres", lambda: inch_to_millimeter(lit(Decimal("2.0000"))), Decimal("50.8000")),
    ("round half up", lambda: round_half_up(lit(2.5), 0), 3.0),
    ("round half away from zero", lambda: round_half_up(lit(-2.5), 0), -3.0),
]


@pytest.mark.parametrize("name,col,want", CASES, ids=[c[0] for c in CASES])
def test_case(spark, name, col, want):
    got = value(spark, col())
    assert (float(got) if isinstance(want, float) else got) == want


def test_insert_of_existing_key_fails(spark):
    with pytest.raises(PySparkException):
        value(spark, X.object_insert(F.create_map(lit("a"), lit(1)), "a", lit(2)))


def test_kinds(spark):
    texts = ["[1]", '{"a":1}', "true", "1", "1.5", '"x"', "null", "1e300"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", X.kind_of(F.parse_json("t")).alias("k"))
    assert [r.k for r in df.collect()] == ["array", "object", "boolean", "integer", "decimal", "string", "null", "double"]


def test_kind_predicates_of_typed_variants(spark):
    df = spark.sql("SELECT cast(date'2024-01-01' AS variant) d, cast(timestamp_ntz'2024-01-01' AS variant) t, cast(x'41' AS variant) b, parse_json('\"2024-01-01\"') s")
    row = df.select(
        X.is_kind("d", "date"), X.is_kind("t", "timestamp_ntz", "timestamp"), X.is_kind("b", "binary"), X.is_kind("s", "date"), X.is_kind("s", "string")
    ).first()
    assert tuple(row) == (True, True, True, False, True)


def test_fingerprint_has_no_separator_collisions(spark):
    df = spark.createDataFrame([("a|b", None), ("a", "b|"), ("a", None), ("a", "-"), (None, "a")], "x string, y string")
    assert df.select(X.row_fingerprint("x", "y").alias("h")).distinct().count() == 5


def test_shape_needs_enough_rows(spark):
    df = spark.createDataFrame([(1.0,), (2.0,)], "x double")
    assert df.agg(X.sample_skew("x"), X.sample_kurtosis("x")).first() == (None, None)


def test_winsorize_matches_pandas_twin(spark, small):
    import pandas as pd

    @F.pandas_udf("double")
    def twin(v: pd.Series) -> pd.Series:
        return v.clip(5.0, 40.0)

    df = spark.read.parquet(f"{small}/events.parquet")
    assert df.filter(twin("value") != winsorize(F.col("value"), 40.0, 5.0)).count() == 0
