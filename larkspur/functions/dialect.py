"""Column functions whose warehouse meaning differs from Spark's built-in of the same name.

All are compositions of built-ins, so they stay inside code generation.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# --- aggregates -----------------------------------------------------------


def regr_valx(y, x) -> Column:
    """x where y is known."""
    return F.when(_c(y).isNotNull(), _c(x))


def regr_valy(y, x) -> Column:
    """y where x is known."""
    return F.when(_c(x).isNotNull(), _c(y))


def sample_skew(col) -> Column:
    """Sample-corrected skewness; null below three rows."""
    n = F.count(_c(col)).cast("double")
    return F.when(n > 2, F.sqrt(n * (n - 1)) / (n - 2) * F.skewness(_c(col)))


def sample_kurtosis(col) -> Column:
    """Sample-corrected excess kurtosis; null below four rows."""
    n = F.count(_c(col)).cast("double")
    return F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.kurtosis(_c(col)) + 6))


# --- strings --------------------------------------------------------------


def split_text(text, sep: str) -> Column:
    """Split on literal text, not on a pattern."""
    return F.split(_c(text), "\\Q" + sep + "\\E")


def ltrim_chars(text, chars: str) -> Column:
    return F.ltrim(_c(text), F.lit(chars))


def rtrim_chars(text, chars: str) -> Column:
    return F.rtrim(_c(text), F.lit(chars))


def charindex(needle: str, text) -> Column:
    """1-based place of ``needle``, 0 if absent."""
    return F.locate(needle, _c(text))


def regexp_like(text, pattern: str) -> Column:
    """True when the whole text matches."""
    return _c(text).rlike(rf"\A(?:{pattern})\z")


def tokens(text, delimiters: str = " ") -> Column:
    """Non-empty tokens between any of the delimiter characters."""
    inner = "".join("\\" + ch if ch in "\\]^-[" else ch for ch in delimiters)
    return F.filter(F.split(_c(text), f"[{inner}]"), lambda t: t != "")


def token_counts(text, delimiters: str = " ") -> Column:
    """(token, n) of each different token: runs of equal ones in the sorted array."""

    def runs(words: Column) -> Column:
        places = F.sequence(F.lit(1), F.size(words))
        heads = F.filter(places, lambda i: (i == 1) | (F.get(words, i - 1) != F.get(words, i - 2)))
        return _once(heads, lambda h: F.transform(h, lambda i, j: F.struct(F.get(words, i - 1).alias("token"), (F.coalesce(F.get(h, j + 1), F.size(words) + 1) - i).cast("bigint").alias("n"))))

    # no sequence counts down from 1 to 0: a text without tokens has no runs
    found = F.when(F.size(tokens(text, delimiters)) > 0, F.array_sort(tokens(text, delimiters)))
    return _once(found, lambda words: F.when(words.isNotNull(), runs(words)))


def _once(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strtok(text, delimiters: str = " ", part: int = 1) -> Column:
    return F.try_element_at(tokens(text, delimiters), F.lit(part))


# --- numbers --------------------------------------------------------------


def truncate(x, digits: int = 0) -> Column:
    """Cut towards zero at ``digits`` decimals."""
    scale = F.lit(Decimal(10) ** digits)
    x = _c(x)
    return F.when(x >= 0, F.floor(x * scale)).otherwise(F.ceil(x * scale)) / scale


def div0(n, d) -> Column:
    """0 for a zero divisor, null for a null one."""
    n, d = _c(n), _c(d)
    return F.when(d == 0, F.lit(0)).otherwise(F.try_divide(n, d))


def div0null(n, d) -> Column:
    """0 for a zero or null divisor."""
    n, d = _c(n), _c(d)
    return F.when(d.isNull() | (d == 0), F.lit(0)).otherwise(F.try_divide(n, d))


def greatest_or_null(*cols) -> Column:
    return _null_if_any(cols, F.greatest)


def least_or_null(*cols) -> Column:
    return _null_if_any(cols, F.least)


def _null_if_any(cols, fn) -> Column:
    cols = [_c(c) for c in cols]
    missing = cols[0].isNull()
    for c in cols[1:]:
        missing = missing | c.isNull()
    return F.when(~missing, fn(*cols))


def round_to_int(x) -> Column:
    """Number to integer, rounding halves away from zero."""
    return F.round(_c(x)).cast("bigint")


# --- dates ----------------------------------------------------------------


def dayofweek0(d) -> Column:
    """0 = Sunday .. 6 = Saturday."""
    return F.dayofweek(_c(d)) - 1


def dayofweek_iso(d) -> Column:
    """1 = Monday .. 7 = Sunday."""
    return F.weekday(_c(d)) + 1


def add_months_date(d, n: int) -> Column:
    return F.add_months(_c(d), n)


def datediff(unit: str, a, b) -> Column:
    """Number of unit boundaries crossed from a to b."""
    a, b = _c(a), _c(b)
    if unit == "day":
        return F.datediff(b, a)
    if unit == "year":
        return F.year(b) - F.year(a)
    if unit == "quarter":
        return (F.year(b) - F.year(a)) * 4 + F.quarter(b) - F.quarter(a)
    if unit == "month":
        return (F.year(b) - F.year(a)) * 12 + F.month(b) - F.month(a)
    if unit == "week":
        return (F.datediff(F.trunc(b, "week"), F.trunc(a, "week")) / 7).cast("int")
    if unit in ("hour", "minute", "second"):
        seconds = {"hour": 3600, "minute": 60, "second": 1}[unit]

        def edge(t: Column) -> Column:
            return F.unix_seconds(F.date_trunc(unit, t.cast("timestamp")))

        return F.floor((edge(b) - edge(a)) / seconds)
    raise ValueError(f"unknown unit {unit}")


def last_day(d, unit: str = "month") -> Column:
    d = _c(d)
    if unit == "month":
        return F.last_day(d)
    months = {"quarter": 3, "year": 12}[unit]
    return F.date_sub(F.add_months(F.trunc(d, unit), months), 1)


def previous_day(d, day: str) -> Column:
    """Latest such weekday before ``d``."""
    return F.next_day(F.date_sub(_c(d), 8), day)


# --- arrays ---------------------------------------------------------------


def array_slice(a, start: int, stop: int) -> Column:
    """Zero-based, end excluded."""
    return F.slice(_c(a), start + 1, stop - start)


def array_position(value, a) -> Column:
    """Zero-based place of the value, null if absent."""
    return F.nullif(F.array_position(_c(a), value), F.lit(0)) - 1


def array_insert(a, pos: int, value) -> Column:
    """Zero-based insert."""
    return F.array_insert(_c(a), pos + 1, value)


def _occurrence(a: Column) -> Column:
    """Each element with its running number among equal elements."""
    return F.transform(
        a,
        lambda x, i: F.struct(x.alias("v"), F.size(F.filter(F.slice(a, 1, i + 1), lambda y: y.eqNullSafe(x))).alias("k")),
    )


def array_intersection(a, b) -> Column:
    """Multiset intersection: the n-th copy stays if the other side has an n-th copy."""
    both = F.array_intersect(_occurrence(_c(a)), _occurrence(_c(b)))
    return F.transform(both, lambda e: e["v"])


def array_except(a, b) -> Column:
    """Multiset difference."""
    left = F.array_except(_occurrence(_c(a)), _occurrence(_c(b)))
    return F.transform(left, lambda e: e["v"])


def array_range(start, stop) -> Column:
    """start .. stop-1, empty when stop is not above start."""
    start, stop = _c(start), _c(stop)
    return F.when(start < stop, F.sequence(start, F.greatest(stop - 1, start))).otherwise(F.array().cast("array<bigint>"))


# --- semi-structured ------------------------------------------------------


def check_json(text) -> Column:
    """Null for valid or missing text, a message otherwise.

    The parser stops after the first value and ignores what follows, so the text must
    also parse as an array element and as a field value.
    """
    text = _c(text)
    element = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    field = F.try_parse_json(F.concat(F.lit('{"a":'), text, F.lit("}")))
    return F.when(text.isNotNull() & (element.isNull() | field.isNull()), F.lit("invalid"))


def strip_null_value(v) -> Column:
    v = _c(v)
    return F.when(~F.is_variant_null(v), v)


def kind_of(v) -> Column:
    """array, object, boolean, integer, decimal, double, string, null, date, timestamp or binary."""
    s = F.schema_of_variant(_c(v))
    return (
        F.when(s.like("ARRAY%"), "array")
        .when(s.like("OBJECT%"), "object")
        .when(s == "BOOLEAN", "boolean")
        .when(s == "BIGINT", "integer")
        .when(s.like("DECIMAL%"), "decimal")
        .when(s.isin("DOUBLE", "FLOAT"), "double")
        .when(s == "STRING", "string")
        .when(s == "VOID", "null")
        .otherwise(F.lower(s))
    )


def is_kind(v, *kinds: str) -> Column:
    """IS_ARRAY, IS_OBJECT, ... : whether the variant holds one of the kinds of ``kind_of``.

    A JSON text never holds a date or a binary value; a variant cast from such a column does.
    """
    return kind_of(v).isin(*kinds)


def object_insert(m, key: str, value, update: bool = False) -> Column:
    """Map with one more entry; an existing key is an error unless ``update``."""
    m = _c(m)
    if update:
        kept = F.map_filter(m, lambda k, _: k != key)
    else:
        kept = F.when(~F.map_contains_key(m, key), m).otherwise(F.raise_error(F.lit(f"duplicate field key {key}")))
    return F.map_concat(kept, F.create_map(F.lit(key), value))


def object_delete(m, *keys: str) -> Column:
    return F.map_filter(_c(m), lambda k, _: ~k.isin(*keys))


def object_pick(m, *keys: str) -> Column:
    return F.map_filter(_c(m), lambda k, _: k.isin(*keys))


# --- hashes and encodings -------------------------------------------------


def row_fingerprint(*cols) -> Column:
    """sha2 over the columns; nulls and separators inside values cannot collide."""
    parts = []
    for c in cols:
        text = _c(c).cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat_ws("|", *parts), 256)


def md5_number(text, lower: bool) -> Column:
    """Upper or lower 64 bits of the md5 as an unsigned decimal number."""
    start = 17 if lower else 1
    return F.conv(F.substring(F.md5(_c(text)), start, 16), 16, 10).cast("decimal(20,0)")
