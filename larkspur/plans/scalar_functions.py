"""The scalar function families as column jobs: one projection over a whole table each."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from larkspur import domain as D
from larkspur.functions import dialect as X
from larkspur.functions.units import round_half_up
from larkspur.registry import query


@query(
    "fn_string",
    r"""SELECT p_partkey, p_name || '-' || p_brand AS f_concat, concat_ws('/', p_type, p_brand, p_name) AS f_concat_ws, length(p_name) AS f_length,
  upper(p_name) AS f_upper, lower(p_brand) AS f_lower,
  array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') AS f_initcap,
  substring(p_name, 2, 3) AS f_substring, left(p_name, 4) AS f_left, right(p_name, 4) AS f_right, trim('  ' || p_name || '  ') AS f_trim,
  ltrim(p_name, 'srb') AS f_ltrim, rtrim(p_name, 'gte') AS f_rtrim, replace(p_name, 'e', 'E') AS f_replace, reverse(p_name) AS f_reverse,
  repeat(p_type, 2) AS f_repeat, array_to_string(string_split(p_name || '.x', '.'), '|') AS f_split, strpos(p_name, 'i') AS f_charindex,
  contains(p_name, 'ring') AS f_contains, starts_with(p_name, 'red') AS f_startswith, ends_with(p_name, 'bolt') AS f_endswith,
  lpad(p_name, 14, '*') AS f_lpad, rpad(p_name, 14, '.') AS f_rpad, regexp_replace(p_name, '[aeiou]', '#', 'g') AS f_regexp_replace,
  nullif(regexp_extract(p_name, '[aeiou]{2,}'), '') AS f_regexp_substr, CAST(len(regexp_extract_all(p_name, '[aeiou]')) AS BIGINT) AS f_regexp_count,
  CASE WHEN regexp_extract(p_name, '[aeiou]') = '' THEN 0 ELSE strpos(p_name, regexp_extract(p_name, '[aeiou]')) END AS f_regexp_instr,
  regexp_full_match(p_name, 'red [a-z]+') AS f_regexp_like, translate(p_name, 'abc', 'xyz') AS f_translate, CAST(ascii(p_name) AS BIGINT) AS f_ascii,
  chr(65 + p_size % 26) AS f_chr, string_split(p_name, ' ')[1] AS f_strtok, array_to_string(string_split(p_name, ' '), ',') AS f_strtok_to_array,
  lower(p_name) = 'red ring' AS f_collate, TRUE AS f_collation, strpos(p_name, 'ring') AS f_position FROM part""",
)
def fn_string(spark, sf):
    n = F.col("p_name")
    return D.table(spark, sf, "part").select(
        "p_partkey",
        F.concat(n, F.lit("-"), "p_brand").alias("f_concat"),
        F.concat_ws("/", "p_type", "p_brand", n).alias("f_concat_ws"),
        F.length(n).alias("f_length"),
        F.upper(n).alias("f_upper"),
        F.lower("p_brand").alias("f_lower"),
        F.initcap(n).alias("f_initcap"),
        F.substring(n, 2, 3).alias("f_substring"),
        F.left(n, F.lit(4)).alias("f_left"),
        F.right(n, F.lit(4)).alias("f_right"),
        F.trim(F.concat(F.lit("  "), n, F.lit("  "))).alias("f_trim"),
        X.ltrim_chars(n, "srb").alias("f_ltrim"),
        X.rtrim_chars(n, "gte").alias("f_rtrim"),
        F.replace(n, F.lit("e"), F.lit("E")).alias("f_replace"),
        F.reverse(n).alias("f_reverse"),
        F.repeat("p_type", 2).alias("f_repeat"),
        F.array_join(X.split_text(F.concat(n, F.lit(".x")), "."), "|").alias("f_split"),
        X.charindex("i", n).alias("f_charindex"),
        F.contains(n, F.lit("ring")).alias("f_contains"),
        F.startswith(n, F.lit("red")).alias("f_startswith"),
        F.endswith(n, F.lit("bolt")).alias("f_endswith"),
        F.lpad(n, 14, "*").alias("f_lpad"),
        F.rpad(n, 14, ".").alias("f_rpad"),
        F.regexp_replace(n, "[aeiou]", "#").alias("f_regexp_replace"),
        F.regexp_substr(n, F.lit("[aeiou]{2,}")).alias("f_regexp_substr"),
        F.regexp_count(n, F.lit("[aeiou]")).alias("f_regexp_count"),
        F.regexp_instr(n, F.lit("[aeiou]")).alias("f_regexp_instr"),
        X.regexp_like(n, "red [a-z]+").alias("f_regexp_like"),
        F.translate(n, "abc", "xyz").alias("f_translate"),
        F.ascii(n).alias("f_ascii"),
        F.char(F.col("p_size") % 26 + 65).alias("f_chr"),
        X.strtok(n, " ", 1).alias("f_strtok"),
        F.array_join(X.tokens(n, " "), ",").alias("f_strtok_to_array"),
        (F.collate(n, "UNICODE_CI") == F.collate(F.lit("RED RING"), "UNICODE_CI")).alias("f_collate"),
        F.collation(F.collate(n, "UNICODE_CI")).endswith("UNICODE_CI").alias("f_collation"),
        F.position(F.lit("ring"), n).alias("f_position"),
    )


@query(
    "fn_numeric",
    """SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS id, abs(v) AS f_abs, CAST(sign(v) AS DOUBLE) AS f_sign,
  CAST(ceil(p) AS DOUBLE) AS f_ceil, CAST(floor(p) AS DOUBLE) AS f_floor, CAST(round(p, 1) AS DOUBLE) AS f_round, CAST(trunc(v * 10) / 10 AS DOUBLE) AS f_trunc,
  round(pow(q, 2), 9) AS f_power, round(sqrt(q), 9) AS f_sqrt, round(cbrt(q), 9) AS f_cbrt, round(exp(q / 50), 9) AS f_exp, round(ln(q), 9) AS f_ln,
  round(ln(q) / ln(2), 9) AS f_log, round(sin(q), 9) AS f_sin, round(cos(q), 9) AS f_cos, round(tan(q / 50), 9) AS f_tan, round(asin(q / 50), 9) AS f_asin,
  round(acos(q / 50), 9) AS f_acos, round(atan(q), 9) AS f_atan, round(atan2(q, 3), 9) AS f_atan2, round(degrees(q), 8) AS f_degrees, round(radians(q), 9) AS f_radians,
  round(pi(), 9) AS f_pi, n % 7 AS f_mod, CASE WHEN n % 5 = 0 THEN 0 ELSE CAST(q AS DOUBLE) / (n % 5) END AS f_div0,
  CASE WHEN flag IS NULL OR flag = 0 THEN 0 ELSE q / flag END AS f_div0null, CASE WHEN flag IS NOT NULL THEN greatest(n, flag) END AS f_greatest,
  CASE WHEN flag IS NOT NULL THEN least(n, flag) END AS f_least, n & 12 AS f_bitand, n | 12 AS f_bitor, xor(n, 12) AS f_bitxor, ~n AS f_bitnot,
  n << 2 AS f_shiftleft, n >> 1 AS f_shiftright, (n >> 1) & 1 AS f_getbit
FROM (SELECT *, CAST(l_extendedprice AS DECIMAL(12,2)) AS p, 25.5 - l_quantity AS v, l_quantity AS q, l_partkey AS n,
  CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN l_linenumber END AS flag FROM lineitem)""",
)
def fn_numeric(spark, sf):
    p, q, n = D.dec("l_extendedprice", 12, 2), F.col("l_quantity"), F.col("l_partkey")
    v = F.lit(25.5) - q
    flag = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", F.col("l_linenumber"))

    def near(col, digits=9):
        # the last bits of transcendental functions differ between engines
        return round_half_up(col, digits)

    return D.table(spark, sf, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("id"),
        F.abs(v).alias("f_abs"),
        F.sign(v).alias("f_sign"),
        F.ceil(p).cast("double").alias("f_ceil"),
        F.floor(p).cast("double").alias("f_floor"),
        F.round(p, 1).alias("f_round"),
        X.truncate(v.cast("decimal(12,2)"), 1).cast("double").alias("f_trunc"),
        near(F.pow(q, 2.0)).alias("f_power"),
        near(F.sqrt(q)).alias("f_sqrt"),
        near(F.cbrt(q)).alias("f_cbrt"),
        near(F.exp(q / 50)).alias("f_exp"),
        near(F.ln(q)).alias("f_ln"),
        near(F.log(2.0, q)).alias("f_log"),
        near(F.sin(q)).alias("f_sin"),
        near(F.cos(q)).alias("f_cos"),
        near(F.tan(q / 50)).alias("f_tan"),
        near(F.asin(q / 50)).alias("f_asin"),
        near(F.acos(q / 50)).alias("f_acos"),
        near(F.atan(q)).alias("f_atan"),
        near(F.atan2(q, F.lit(3.0))).alias("f_atan2"),
        near(F.degrees(q), 8).alias("f_degrees"),
        near(F.radians(q)).alias("f_radians"),
        near(F.pi()).alias("f_pi"),
        (n % 7).alias("f_mod"),
        X.div0(q, n % 5).cast("double").alias("f_div0"),
        X.div0null(q, flag).cast("double").alias("f_div0null"),
        X.greatest_or_null(n, flag).alias("f_greatest"),
        X.least_or_null(n, flag).alias("f_least"),
        n.bitwiseAND(12).alias("f_bitand"),
        n.bitwiseOR(12).alias("f_bitor"),
        n.bitwiseXOR(12).alias("f_bitxor"),
        F.bitwise_not(n).alias("f_bitnot"),
        F.shiftleft(n, 2).alias("f_shiftleft"),
        F.shiftright(n, 1).alias("f_shiftright"),
        F.getbit(n, F.lit(1)).alias("f_getbit"),
    )


@query(
    "fn_datetime",
    """SELECT o_orderkey, strftime(make_date(year(d), month(d), 1), '%Y-%m-%d') AS f_from_parts, strftime(make_timestamp(year(d), month(d), day(d), 12, 30, 15), '%Y-%m-%d %H:%M:%S') AS f_ts_from_parts,
  strftime(make_time(12, 30, 15)+ INTERVAL 0 SECOND + DATE '2000-01-01', '%H:%M:%S') AS f_time_from_parts,
  CAST(year(d) AS BIGINT) AS f_year, CAST(month(d) AS BIGINT) AS f_month, CAST(day(d) AS BIGINT) AS f_day, CAST(dayofyear(d) AS BIGINT) AS f_dayofyear,
  CAST(quarter(d) AS BIGINT) AS f_quarter, CAST(hour(t) AS BIGINT) AS f_hour, CAST(minute(t) AS BIGINT) AS f_minute, CAST(second(t) AS BIGINT) AS f_second,
  CAST(dayofweek(d) AS BIGINT) AS f_dayofweek, CAST(isodow(d) AS BIGINT) AS f_dayofweekiso, CAST(weekofyear(d) AS BIGINT) AS f_week,
  strftime(d + 45, '%Y-%m-%d') AS f_dateadd_day, strftime(CAST(d + INTERVAL 1 MONTH AS DATE), '%Y-%m-%d') AS f_add_months,
  CAST(date_diff('day', d, r) AS BIGINT) AS f_diff_day, CAST(date_diff('day', date_trunc('week', d), date_trunc('week', r)) // 7 AS BIGINT) AS f_diff_week, CAST(date_diff('month', d, r) AS BIGINT) AS f_diff_month,
  CAST(date_diff('quarter', d, r) AS BIGINT) AS f_diff_quarter, CAST(date_diff('year', d, r) AS BIGINT) AS f_diff_year,
  CAST(date_diff('hour', t, CAST(r AS TIMESTAMP)) AS BIGINT) AS f_diff_hour, CAST(date_diff('minute', t, CAST(r AS TIMESTAMP)) AS BIGINT) AS f_diff_minute,
  strftime(date_trunc('month', d), '%Y-%m-%d') AS f_trunc_month, strftime(date_trunc('year', d), '%Y-%m-%d') AS f_trunc_year,
  strftime(date_trunc('week', d), '%Y-%m-%d') AS f_trunc_week, strftime(date_trunc('quarter', d), '%Y-%m-%d') AS f_trunc_quarter,
  strftime(date_trunc('hour', t), '%Y-%m-%d %H:%M:%S') AS f_trunc_hour, strftime(last_day(d), '%Y-%m-%d') AS f_last_day,
  strftime(CAST(date_trunc('quarter', d) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE), '%Y-%m-%d') AS f_last_day_quarter,
  strftime(CAST(date_trunc('year', d) + INTERVAL 12 MONTH - INTERVAL 1 DAY AS DATE), '%Y-%m-%d') AS f_last_day_year,
  strftime(d + CAST(7 - (isodow(d) - 1) % 7 AS INTEGER), '%Y-%m-%d') AS f_next_monday, strftime(d - CAST(CASE WHEN isodow(d) = 1 THEN 7 ELSE isodow(d) - 1 END AS INTEGER), '%Y-%m-%d') AS f_previous_monday,
  strftime(d, '%b') AS f_monthname, strftime(d, '%a') AS f_dayname, CAST(date_diff('second', t, CAST(r AS TIMESTAMP)) AS BIGINT) AS f_diff_second,
  strftime(t + INTERVAL 2 HOUR, '%Y-%m-%d %H:%M:%S') AS f_dateadd_hour, CASE WHEN day(r) = day(d) OR (last_day(r) = r AND last_day(d) = d)
    THEN CAST(date_diff('month', d, r) AS DOUBLE) ELSE round(date_diff('month', d, r) + (day(r) - day(d)) / 31, 8) END AS f_months_between
FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, o_orderdate + to_seconds(o_orderkey % 86400) AS t, DATE '2001-08-01' AS r FROM orders)""",
)
def fn_datetime(spark, sf, as_of: date = D.AS_OF_ORDERS):
    base = D.table(spark, sf, "orders").select(
        "o_orderkey",
        F.to_date("o_orderdate").alias("d"),
        (F.col("o_orderdate") + F.make_dt_interval(secs=F.col("o_orderkey") % 86400)).alias("t"),
    )
    d, t, r = F.col("d"), F.col("t"), F.lit(as_of)
    rt = r.cast("timestamp_ntz")
    return base.select(
        "o_orderkey",
        F.make_date(F.year(d), F.month(d), F.lit(1)).alias("f_from_parts"),
        F.make_timestamp_ntz(F.year(d), F.month(d), F.day(d), F.lit(12), F.lit(30), F.lit(15)).alias("f_ts_from_parts"),
        F.date_format(F.make_timestamp_ntz(F.lit(2000), F.lit(1), F.lit(1), F.lit(12), F.lit(30), F.lit(15)), "HH:mm:ss").alias("f_time_from_parts"),
        F.year(d).alias("f_year"),
        F.month(d).alias("f_month"),
        F.dayofmonth(d).alias("f_day"),
        F.dayofyear(d).alias("f_dayofyear"),
        F.quarter(d).alias("f_quarter"),
        F.extract(F.lit("HOUR"), t).alias("f_hour"),
        F.date_part(F.lit("MINUTE"), t).alias("f_minute"),
        F.second(t).alias("f_second"),
        X.dayofweek0(d).alias("f_dayofweek"),
        X.dayofweek_iso(d).alias("f_dayofweekiso"),
        F.weekofyear(d).alias("f_week"),
        F.date_add(d, 45).alias("f_dateadd_day"),
        X.add_months_date(d, 1).alias("f_add_months"),
        X.datediff("day", d, r).alias("f_diff_day"),
        X.datediff("week", d, r).alias("f_diff_week"),
        X.datediff("month", d, r).alias("f_diff_month"),
        X.datediff("quarter", d, r).alias("f_diff_quarter"),
        X.datediff("year", d, r).alias("f_diff_year"),
        X.datediff("hour", t, rt).alias("f_diff_hour"),
        X.datediff("minute", t, rt).alias("f_diff_minute"),
        F.trunc(d, "month").alias("f_trunc_month"),
        F.trunc(d, "year").alias("f_trunc_year"),
        F.trunc(d, "week").alias("f_trunc_week"),
        F.trunc(d, "quarter").alias("f_trunc_quarter"),
        F.date_trunc("hour", t).alias("f_trunc_hour"),
        X.last_day(d).alias("f_last_day"),
        X.last_day(d, "quarter").alias("f_last_day_quarter"),
        X.last_day(d, "year").alias("f_last_day_year"),
        F.next_day(d, "MON").alias("f_next_monday"),
        X.previous_day(d, "MON").alias("f_previous_monday"),
        F.monthname(d).alias("f_monthname"),
        F.dayname(d).alias("f_dayname"),
        X.datediff("second", t, rt).alias("f_diff_second"),
        (t + F.expr("INTERVAL 2 HOURS")).alias("f_dateadd_hour"),
        F.months_between(r, d).alias("f_months_between"),
    )


@query(
    "fn_convert_conditional",
    """SELECT event_id, CAST(floor(value + 0.5) AS BIGINT) AS f_cast_int, CAST(floor(value + 0.5) AS BIGINT) AS f_to_number,
  CAST(CAST(value AS DECIMAL(10,1)) AS DOUBLE) AS f_to_decimal, CAST(CAST(value AS VARCHAR) AS DOUBLE) AS f_to_double,
  strftime(CAST(strftime(ts, '%Y-%m-%d') AS DATE), '%Y-%m-%d') AS f_to_date, strftime(ts, '%Y-%m-%d %H:%M:%S') AS f_to_timestamp, strftime(ts, '%H:%M:%S') AS f_to_time,
  strftime(ts, '%Y/%m/%d') AS f_to_char_date, format('{:,.2f}', CAST(value AS DOUBLE)) AS f_to_char_num, event_type IN ('purchase', 'view') AS f_to_boolean,
  hex(encode(event_type)) AS f_to_binary, TRY_CAST(event_type AS DOUBLE) AS f_try_number, CAST(TRY_CAST(CASE WHEN event_type = 'view' THEN '12' ELSE event_type END AS INTEGER) AS BIGINT) AS f_try_cast,
  strftime(TRY_CAST(CASE WHEN event_type = 'view' THEN '2024-02-29' ELSE '2023-02-29' END AS DATE), '%Y-%m-%d') AS f_try_date,
  TRY_CAST(CASE WHEN event_type = 'view' THEN 'true' ELSE 'maybe' END AS BOOLEAN) AS f_try_boolean,
  CASE WHEN value > 20 THEN 'high' WHEN value > 5 THEN 'mid' ELSE 'low' END AS f_case, CASE WHEN value > 20 THEN 1 ELSE 0 END::BIGINT AS f_iff,
  coalesce(CASE WHEN event_type = 'error' THEN NULL ELSE user_id END, -1) AS f_coalesce, CASE WHEN event_type <> 'error' THEN 'known' ELSE 'unknown' END AS f_nvl2,
  nullif(event_type, 'error') AS f_nullif, nullif(user_id % 5, 0) AS f_nullifzero, coalesce(nullif(user_id % 5, 0), 0) AS f_zeroifnull,
  event_type AS f_to_array, CAST(regexp_extract(props, '(\\d+)', 1) AS BIGINT) AS f_to_object, event_type AS f_to_variant,
  strftime(date_trunc('second', ts) - INTERVAL 2 HOUR, '%Y-%m-%d %H:%M:%S') AS f_tz_instant, '+02:00' AS f_tz_offset, CASE WHEN event_type = 'view' THEN NULL ELSE '10:30:00' END AS f_try_time,
  CASE WHEN event_type = 'view' THEN NULL ELSE '2024-03-01 10:30:00' END AS f_try_timestamp, CASE WHEN event_type <> 'view' THEN 'A' END AS f_try_binary,
  CASE event_type WHEN 'error' THEN 'E' WHEN 'click' THEN 'C' ELSE '?' END AS f_decode, nullif(event_type, 'error') IS NOT DISTINCT FROM NULL AS f_equal_null
FROM events""",
)
def fn_convert_conditional(spark, sf):
    value, kind, ts, user = F.col("value"), F.col("event_type"), F.col("ts"), F.col("user_id")
    text = value.cast("string")
    known = F.when(kind != "error", user)
    view = kind == "view"
    zoned = F.concat(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"), F.lit("+02:00"))
    return D.table(spark, sf, "events").select(
        "event_id",
        X.round_to_int(text.cast("decimal(18,4)")).alias("f_cast_int"),
        F.round(text.cast("decimal(38,4)")).cast("bigint").alias("f_to_number"),
        text.cast("decimal(10,1)").alias("f_to_decimal"),
        text.cast("double").alias("f_to_double"),
        F.to_date(F.date_format(ts, "yyyy-MM-dd"), "yyyy-MM-dd").alias("f_to_date"),
        F.to_timestamp_ntz(F.date_format(ts, "dd.MM.yyyy HH:mm:ss"), F.lit("dd.MM.yyyy HH:mm:ss")).alias("f_to_timestamp"),
        F.date_format(ts, "HH:mm:ss").alias("f_to_time"),
        F.date_format(ts, "yyyy/MM/dd").alias("f_to_char_date"),
        F.format_number(value, 2).alias("f_to_char_num"),
        F.when(kind.isin("purchase", "view"), "yes").otherwise("no").cast("boolean").alias("f_to_boolean"),
        F.hex(F.to_binary(kind, F.lit("utf-8"))).alias("f_to_binary"),
        kind.try_cast("double").alias("f_try_number"),
        F.when(view, "12").otherwise(kind).try_cast("int").alias("f_try_cast"),
        F.try_to_date(F.when(view, "2024-02-29").otherwise("2023-02-29")).alias("f_try_date"),
        F.when(view, "true").otherwise("maybe").try_cast("boolean").alias("f_try_boolean"),
        F.when(value > 20, "high").when(value > 5, "mid").otherwise("low").alias("f_case"),
        F.expr("if(value > 20, 1, 0)").alias("f_iff"),
        F.coalesce(known, F.lit(-1)).alias("f_coalesce"),
        F.nvl2(known, F.lit("known"), F.lit("unknown")).alias("f_nvl2"),
        F.nullif(kind, F.lit("error")).alias("f_nullif"),
        F.nullifzero(user % 5).alias("f_nullifzero"),
        F.zeroifnull(F.nullifzero(user % 5)).alias("f_zeroifnull"),
        F.from_json(F.concat(F.lit('["'), kind, F.lit('"]')), "array<string>")[0].alias("f_to_array"),
        F.from_json("props", "map<string,bigint>")["k"].alias("f_to_object"),
        F.variant_get(F.parse_json(F.to_json(F.struct(kind))), "$.event_type", "string").alias("f_to_variant"),
        # a zoned timestamp is its instant plus the offset it was written with
        F.to_timestamp(zoned, "yyyy-MM-dd HH:mm:ssXXX").alias("f_tz_instant"),
        F.right(zoned, F.lit(6)).alias("f_tz_offset"),
        F.date_format(F.try_to_timestamp(F.when(view, "10:61:00").otherwise("10:30:00"), F.lit("HH:mm:ss")), "HH:mm:ss").alias("f_try_time"),
        F.try_to_timestamp(F.when(view, "soon").otherwise("2024-03-01 10:30:00")).alias("f_try_timestamp"),
        F.decode(F.try_to_binary(F.when(view, "4x").otherwise("41"), F.lit("hex")), "UTF-8").alias("f_try_binary"),
        F.expr("decode(event_type, 'error', 'E', 'click', 'C', '?')").alias("f_decode"),
        F.equal_null(F.nullif(kind, F.lit("error")), F.lit(None)).alias("f_equal_null"),
    )


@query(
    "fn_array",
    """SELECT o_orderkey, array_to_string([a, b, c], ',') AS f_construct, array_to_string(list_filter([a, NULL, c], lambda x: x IS NOT NULL), ',') AS f_compact, 3 AS f_size,
  array_to_string([a, b, c, 9], ',') AS f_append, array_to_string([9, a, b, c], ',') AS f_prepend, array_to_string([a, b, c, c, 7], ',') AS f_cat,
  array_to_string(list_sort(list_distinct([a, b, c])), ',') AS f_distinct, list_has_any([a, b, c], [0, 1]) AS f_overlap, array_to_string([b, c], ',') AS f_slice,
  list_contains([a, b, c], 2) AS f_contains, CASE WHEN a = 2 THEN 0 WHEN b = 2 THEN 1 WHEN c = 2 THEN 2 END::BIGINT AS f_position,
  array_to_string([a, 8, b, c], ',') AS f_insert,
  array_to_string(list_concat(list_resize([0], least(1, len(list_filter([a, b, c], lambda x: x = 0))), 0), list_resize([1], least(2, len(list_filter([a, b, c], lambda x: x = 1))), 1)), ',') AS f_intersection,
  array_to_string(list_sort(list_concat(list_filter([a, b, c], lambda x: x > 1), list_concat(list_resize([0], greatest(len(list_filter([a, b, c], lambda x: x = 0)) - 1, 0), 0),
    list_resize([1], greatest(len(list_filter([a, b, c], lambda x: x = 1)) - 2, 0), 1)))), ',') AS f_except,
  a || '-' || b || '-' || c AS f_to_string, array_to_string(generate_series(a, b - 1), ',') AS f_range
FROM (SELECT o_orderkey, o_orderkey % 3 AS a, o_custkey % 4 AS b, o_custkey % 3 AS c FROM orders)""",
)
def fn_array(spark, sf):
    base = D.table(spark, sf, "orders").select(
        "o_orderkey", (F.col("o_orderkey") % 3).alias("a"), (F.col("o_custkey") % 4).alias("b"), (F.col("o_custkey") % 3).alias("c")
    )
    a, b, c = F.col("a"), F.col("b"), F.col("c")
    arr = F.array(a, b, c)
    other = F.array(*[F.lit(x).cast("bigint") for x in (0, 1, 1)])

    def text(col):
        return F.array_join(col.cast("array<string>"), ",")

    return base.select(
        "o_orderkey",
        text(arr).alias("f_construct"),
        text(F.array_compact(F.array(a, F.lit(None).cast("bigint"), c))).alias("f_compact"),
        F.size(arr).alias("f_size"),
        text(F.array_append(arr, F.lit(9).cast("bigint"))).alias("f_append"),
        text(F.array_prepend(arr, F.lit(9).cast("bigint"))).alias("f_prepend"),
        text(F.concat(arr, F.array(c, F.lit(7).cast("bigint")))).alias("f_cat"),
        text(F.sort_array(F.array_distinct(arr))).alias("f_distinct"),
        F.arrays_overlap(arr, other).alias("f_overlap"),
        text(X.array_slice(arr, 1, 3)).alias("f_slice"),
        F.array_contains(arr, 2).alias("f_contains"),
        X.array_position(F.lit(2).cast("bigint"), arr).alias("f_position"),
        text(X.array_insert(arr, 1, F.lit(8).cast("bigint"))).alias("f_insert"),
        text(F.sort_array(X.array_intersection(arr, other))).alias("f_intersection"),
        text(F.sort_array(X.array_except(arr, other))).alias("f_except"),
        F.array_join(arr.cast("array<string>"), "-").alias("f_to_string"),
        text(X.array_range(a, b)).alias("f_range"),
    )


@query(
    "row_fingerprint",
    """SELECT doc_id, md5(text) AS md5_hex, sha1(text) AS sha1_hex, sha256(text) AS sha2_hex,
  sha256(length(CAST(doc_id AS VARCHAR)) || ':' || doc_id || '|' || length(lang) || ':' || lang || '|' || length(text) || ':' || text) AS row_hash FROM documents""",
)
def row_fingerprint(spark, sf):
    return D.table(spark, sf, "documents").select(
        "doc_id",
        F.md5("text").alias("md5_hex"),
        F.sha1("text").alias("sha1_hex"),
        F.sha2("text", 256).alias("sha2_hex"),
        X.row_fingerprint("doc_id", "lang", "text").alias("row_hash"),
    )


@query("row_hash_number")
def row_hash_number(spark, sf):
    """64-bit row hashes and the halves of the md5 number; values are engine-specific."""
    return D.table(spark, sf, "customer").select(
        "c_custkey",
        F.xxhash64("c_name", "c_mktsegment").alias("hash64"),
        X.md5_number("c_name", lower=False).alias("md5_upper64"),
        X.md5_number("c_name", lower=True).alias("md5_lower64"),
        F.hex(F.unhex(F.sha2("c_name", 512))).alias("sha512_binary"),
    )


@query(
    "encode_columns",
    """SELECT c_custkey, base64(encode(c_name)) AS b64, c_name AS b64_back, hex(encode(c_name)) AS hex_upper, lower(hex(encode(c_name))) AS hex_lower, c_name AS hex_back,
  CAST(NULL AS VARCHAR) AS bad_hex, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS tolerant FROM customer""",
)
def encode_columns(spark, sf):
    name, segment = F.col("c_name"), F.col("c_mktsegment")
    code = F.base64(F.to_binary(segment, F.lit("utf-8")))
    mixed = F.when(F.col("c_custkey") % 2 == 0, code).otherwise("not base64!")
    return D.table(spark, sf, "customer").select(
        "c_custkey",
        F.base64(name.cast("binary")).alias("b64"),
        F.decode(F.unbase64(F.base64(name.cast("binary"))), "UTF-8").alias("b64_back"),
        F.hex(name).alias("hex_upper"),
        F.lower(F.hex(name)).alias("hex_lower"),
        F.decode(F.unhex(F.hex(name)), "UTF-8").alias("hex_back"),
        F.decode(F.try_to_binary(name, F.lit("hex")), "UTF-8").alias("bad_hex"),
        F.decode(F.try_to_binary(mixed, F.lit("base64")), "UTF-8").alias("tolerant"),
    )
