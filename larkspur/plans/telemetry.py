"""Rollups over run events and alerts."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import functions as F

from larkspur import domain as D
from larkspur.functions.units import round_half_up
from larkspur.operators.telemetry import event_rows
from larkspur.plans import datasets as P
from larkspur.plans.aggregates import joined_texts, n_rows
from larkspur.plans.windows import severity_rank
from larkspur.registry import query
from larkspur.session import durable

AS_OF = D.AS_OF_EVENTS


def _since(col: str, as_of: datetime, **span):
    return F.col(col) > F.lit(as_of - timedelta(**span)).cast("timestamp_ntz")


ALERT_FIELDS = ["alert_id", "alert_time", "alert_name", "severity", "category", "message", "record_count", "affected_table", "resolved_flag"]
ALERT_SQL = """SELECT alert_id, strftime(alert_time, '%Y-%m-%d %H:%M:%S') AS alert_time, alert_name, severity, category, message, record_count, affected_table,
  resolved_flag FROM v_alerts"""


@query("tel_recent_alerts", f"{ALERT_SQL} WHERE alert_time > TIMESTAMP '2024-01-31' - INTERVAL 7 DAY")
def tel_recent_alerts(spark, sf, as_of=AS_OF):
    return (
        D.alerts(spark, sf)
        .filter(_since("alert_time", as_of, days=7))
        .select(*ALERT_FIELDS)
        .orderBy(F.desc("alert_time"), "alert_id")
    )


@query(
    "tel_error_summary",
    """SELECT strftime(event_timestamp, '%Y-%m-%d') AS error_date, procedure_name, count(*) AS error_count, string_agg(DISTINCT error_message, '; ' ORDER BY error_message)
  AS error_messages FROM v_stage_events WHERE error_flag AND event_timestamp > TIMESTAMP '2024-01-31' - INTERVAL 30 DAY GROUP BY 1, 2""",
)
def tel_error_summary(spark, sf, as_of=AS_OF):
    bad = (
        D.stage_events(spark, sf)
        .filter(F.col("error_flag") & _since("event_timestamp", as_of, days=30))
        .withColumn("error_date", F.to_date("event_timestamp"))
    )
    keys = ["error_date", "procedure_name"]
    # counted per message first: the text list then grows with distinct messages, not with errors
    per_message = bad.groupBy(*keys, "error_message").agg(n_rows("n"))
    counts = per_message.groupBy(*keys).agg(F.sum("n").alias("error_count"))
    return counts.join(joined_texts(per_message, keys, "error_message", "error_messages"), keys)


@query(
    "tel_performance",
    """SELECT procedure_name, count(*) AS execution_count, CAST(sum(execution_time_ms) AS DOUBLE) / count(*) AS avg_execution_time_ms,
  max(execution_time_ms) AS max_execution_time_ms, min(execution_time_ms) AS min_execution_time_ms, CAST(sum(records_processed) AS BIGINT) AS total_records_processed
FROM v_stage_events WHERE event_timestamp > TIMESTAMP '2024-01-31' - INTERVAL 7 DAY AND execution_time_ms IS NOT NULL GROUP BY 1""",
)
def tel_performance(spark, sf, as_of=AS_OF):
    ms = F.col("execution_time_ms")
    return (
        D.stage_events(spark, sf)
        .filter(_since("event_timestamp", as_of, days=7) & ms.isNotNull())
        .groupBy("procedure_name")
        .agg(
            n_rows("execution_count"),
            D.mean(ms).alias("avg_execution_time_ms"),
            F.max(ms).alias("max_execution_time_ms"),
            F.min(ms).alias("min_execution_time_ms"),
            F.sum("records_processed").alias("total_records_processed"),
        )
        .orderBy(F.desc("avg_execution_time_ms"))
    )


@query(
    "tel_by_severity",
    "SELECT severity, count(*) AS alert_count, string_agg(DISTINCT alert_name, ', ' ORDER BY alert_name) AS alert_types FROM v_alerts WHERE alert_time > TIMESTAMP '2024-01-30' GROUP BY 1",
)
def tel_by_severity(spark, sf, as_of=AS_OF):
    per_name = D.alerts(spark, sf).filter(_since("alert_time", as_of, days=1)).groupBy("severity", "alert_name").agg(n_rows("n"))
    counts = per_name.groupBy("severity").agg(F.sum("n").alias("alert_count"))
    return counts.join(joined_texts(per_name, ["severity"], "alert_name", "alert_types", ", "), "severity").orderBy(severity_rank())


@query(
    "tel_by_category",
    "SELECT category, count(*) AS alert_count, strftime(max(alert_time), '%Y-%m-%d %H:%M:%S') AS last_alert_time FROM v_alerts WHERE alert_time > TIMESTAMP '2024-01-24' GROUP BY 1",
)
def tel_by_category(spark, sf, as_of=AS_OF):
    recent = D.alerts(spark, sf).filter(_since("alert_time", as_of, days=7))
    return recent.groupBy("category").agg(n_rows("alert_count"), F.max("alert_time").alias("last_alert_time")).orderBy(F.desc("alert_count"))


@query(
    "tel_unresolved",
    """SELECT alert_id, alert_name, severity, category, message, record_count, affected_table, strftime(alert_time, '%Y-%m-%d %H:%M:%S') AS alert_time,
  count(*) OVER (PARTITION BY severity) AS open_in_severity FROM v_alerts WHERE NOT resolved_flag AND alert_time > TIMESTAMP '2024-01-30 23:00:00' - INTERVAL 6 HOUR""",
)
def tel_unresolved(spark, sf, as_of=datetime(2024, 1, 30, 23), hours: int = 6):
    """Open alerts by severity, newest first, with the number open per severity."""
    recent = D.alerts(spark, sf).filter(~F.col("resolved_flag") & _since("alert_time", as_of, hours=hours))
    per_level = recent.groupBy("severity").agg(n_rows("open_in_severity"))
    return (
        recent.join(per_level, "severity")
        .select("alert_id", "alert_name", "severity", "category", "message", "record_count", "affected_table", "alert_time", "open_in_severity")
        .orderBy("severity", F.desc("alert_time"))
    )


@query(
    "tel_recent_errors",
    """SELECT event_id, strftime(event_timestamp, '%Y-%m-%d %H:%M:%S') AS event_timestamp, procedure_name, process_step, error_message, trace_id FROM v_stage_events
WHERE error_flag AND event_timestamp > TIMESTAMP '2024-01-30 23:00:00' - INTERVAL 1 HOUR""",
)
def tel_recent_errors(spark, sf, as_of=datetime(2024, 1, 30, 23)):
    return (
        D.stage_events(spark, sf)
        .filter(F.col("error_flag") & _since("event_timestamp", as_of, hours=1))
        .select("event_id", "event_timestamp", "procedure_name", "process_step", "error_message", "trace_id")
        .orderBy(F.desc("event_timestamp"))
    )


REPORT_SQL = """WITH brand AS (SELECT DISTINCT menu_type_id, truck_brand_name FROM v_menu),
day AS (SELECT truck_brand_name, primary_city, region, count(*) AS n, CAST(sum(order_total) AS DOUBLE) AS r, count(DISTINCT customer_id) AS u, CAST(sum(order_total) AS DOUBLE) / count(*) AS a
  FROM v_header JOIN v_truck USING (truck_id) JOIN brand USING (menu_type_id) WHERE CAST(order_ts AS DATE) = DATE '1998-03-10' GROUP BY 1, 2, 3),
rows AS (SELECT * FROM day UNION ALL SELECT 'ALL', NULL, NULL, CAST(sum(n) AS BIGINT), sum(r), CAST(sum(u) AS BIGINT), sum(a) / count(*) FROM day HAVING count(*) > 0)
SELECT truck_brand_name, primary_city, region, n AS total_orders, '$' || format('{:,.2f}', r) AS total_revenue, u AS unique_customers, '$' || format('{:,.2f}', a) AS avg_order_value FROM rows"""


@query("tel_daily_report", REPORT_SQL)
def tel_daily_report(spark, sf, day: date = date(1998, 3, 10)):
    """One day's sales per brand and city with a total row; the total is added from those rows."""
    header = D.order_header(spark, sf, since=day, until=day)
    lines = P.brand_sales(header, D.truck(spark, sf), D.menu(spark, sf)).select(
        "truck_brand_name", "primary_city", "region", "total_orders", "total_revenue", "unique_customers", "avg_order_value"
    )
    lines = durable(lines)  # a row per brand and city, worked out once for both parts
    total = lines.agg(
        F.lit("ALL").alias("truck_brand_name"),
        F.sum("total_orders").alias("total_orders"),
        F.sum("total_revenue").alias("total_revenue"),
        F.sum("unique_customers").alias("unique_customers"),
        F.avg("avg_order_value").alias("avg_order_value"),
    ).filter("total_orders > 0")
    both = lines.unionByName(total, allowMissingColumns=True)

    def money(name):
        return F.concat(F.lit("$"), F.format_number(name, 2))

    return both.withColumns({c: money(c) for c in ("total_revenue", "avg_order_value")})


@query(
    "tel_metrics",
    """SELECT 'stream_pending_records' AS metric_name, CAST(count(*) AS DOUBLE) AS metric_value, 'records' AS metric_unit, '{"stream_name":"changes"}' AS dimension_attributes
FROM v_changes WHERE commit_ts > TIMESTAMP '2024-01-24'
UNION ALL SELECT 'unresolved_alerts', CAST(count(*) AS DOUBLE), 'count', '{"severity":"' || severity || '","time_window":"last_24h"}' FROM v_alerts
  WHERE NOT resolved_flag AND alert_time > TIMESTAMP '2024-01-29 23:00:00' GROUP BY severity
UNION ALL SELECT 'avg_procedure_execution_time', CAST(sum(execution_time_ms) AS DOUBLE) / count(*), 'milliseconds', '{"procedure_name":"' || procedure_name || '","time_window":"last_1h"}'
  FROM v_stage_events WHERE event_timestamp > TIMESTAMP '2024-01-30 22:00:00' GROUP BY procedure_name""",
)
def tel_metrics(spark, sf, as_of=datetime(2024, 1, 30, 23), offset=datetime(2024, 1, 24)):
    """Backlog, open alerts and step times as metric rows with JSON dimensions."""

    def metric(df, name, unit, **dims):
        return df.select(
            F.lit(name).alias("metric_name"),
            F.col("v").cast("double").alias("metric_value"),
            F.lit(unit).alias("metric_unit"),
            F.to_json(F.struct(*[value.alias(tag) for tag, value in dims.items()])).alias("dimension_attributes"),
        )

    backlog = D.change_log(spark, sf).filter(F.col("commit_ts") > F.lit(offset).cast("timestamp_ntz")).agg(n_rows("v"))
    unresolved = (
        D.alerts(spark, sf).filter(~F.col("resolved_flag") & _since("alert_time", as_of, days=1)).groupBy("severity").agg(n_rows("v"))
    )
    speed = (
        D.stage_events(spark, sf)
        .filter(F.col("execution_time_ms").isNotNull() & _since("event_timestamp", as_of, hours=1))
        .groupBy("procedure_name")
        .agg(D.mean("execution_time_ms").alias("v"))
    )
    parts = [
        metric(backlog, "stream_pending_records", "records", stream_name=F.lit("changes")),
        metric(unresolved, "unresolved_alerts", "count", severity=F.col("severity"), time_window=F.lit("last_24h")),
        metric(speed, "avg_procedure_execution_time", "milliseconds", procedure_name=F.col("procedure_name"), time_window=F.lit("last_1h")),
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


@query(
    "tel_event_append",
    """SELECT trace_id, count(*) AS events, count(*) FILTER (event_type = 'error') AS errors, max(length(error_message)) AS longest_message FROM
(SELECT user_id || '-' || strftime(ts, '%Y%m%d') AS trace_id, event_type, CASE WHEN event_type = 'error' THEN repeat('failed with code ' || regexp_extract(props, '(\\d+)', 1) || ' ', 40) END AS error_message FROM events) GROUP BY 1""",
)
def tel_event_append(spark, sf):
    """Append event rows to the log and read it back per trace."""
    from larkspur.sources.files import append_table

    raw = D.table(spark, sf, "events")
    failed = F.col("event_type") == "error"
    rows = event_rows(
        raw,
        trace_id=F.concat(D.text_id("user_id"), F.lit("-"), F.date_format("ts", "yyyyMMdd")),
        timestamp=F.col("ts"),
        record_type=F.when(failed, "LOG").otherwise("SPAN"),
        step=F.col("event_type"),
        attributes=F.struct(F.col("user_id"), F.col("value")),
        error=F.when(failed, F.repeat(F.concat(F.lit("failed with code "), D.text_id(D.payload()), F.lit(" ")), 40)),
    )
    log = append_table(spark, [rows.filter(~F.col("error_flag")), rows.filter("error_flag")], "event-log")
    return log.groupBy("trace_id").agg(
        n_rows("events"), F.count_if("error_flag").alias("errors"), F.max(F.length("error_message")).alias("longest_message")
    )


@query(
    "tel_trace",
    """SELECT event_id, strftime(event_timestamp, '%Y-%m-%d %H:%M:%S') AS event_timestamp, record_type, process_step, message FROM v_stage_events
WHERE trace_id = '7-20240115'""",
)
def tel_trace(spark, sf, trace_id: str = "7-20240115"):
    return (
        D.stage_events(spark, sf)
        .filter(F.col("trace_id") == trace_id)
        .select("event_id", "event_timestamp", "record_type", "process_step", "message")
        .orderBy("event_timestamp", "event_id")
    )


@query(
    "tel_run_health",
    """SELECT trace_id, CAST(epoch(date_trunc('second', max(event_timestamp))) - epoch(date_trunc('second', min(event_timestamp))) AS BIGINT) AS run_seconds,
  count(*) FILTER (error_flag) AS failures, CASE WHEN bool_or(error_flag) THEN 'FAILED' ELSE 'SUCCEEDED' END AS state FROM v_stage_events GROUP BY 1""",
)
def tel_run_health(spark, sf):
    def second(col):
        return F.unix_seconds(col.cast("timestamp"))

    ts = F.col("event_timestamp")
    return (
        D.stage_events(spark, sf)
        .groupBy("trace_id")
        .agg(
            (second(F.max(ts)) - second(F.min(ts))).alias("run_seconds"),
            F.count_if("error_flag").alias("failures"),
            F.when(F.bool_or("error_flag"), "FAILED").otherwise("SUCCEEDED").alias("state"),
        )
    )


@query(
    "tel_usage_rollup",
    """SELECT procedure_name, count(*) AS runs, CAST(sum(execution_time_ms) AS BIGINT) AS total_ms, max(execution_time_ms) AS slowest_ms,
  floor(CAST(sum(records_processed) AS DOUBLE) * 1048576 / 1073741824 * 100 + 0.5) / 100 AS gb_scanned FROM v_stage_events GROUP BY 1""",
)
def tel_usage_rollup(spark, sf):
    scanned = F.sum("records_processed").cast("double") * 1048576 / F.lit(2**30)
    return (
        D.stage_events(spark, sf)
        .groupBy("procedure_name")
        .agg(
            n_rows("runs"),
            F.sum("execution_time_ms").alias("total_ms"),
            F.max("execution_time_ms").alias("slowest_ms"),
            round_half_up(scanned, 2).alias("gb_scanned"),
        )
        .orderBy(F.desc("total_ms"))
    )
