"""Loads and unloads of staged files. The files are written from the given tables first."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur import domain as D
from larkspur.plans.aggregates import n_rows
from larkspur.registry import query
from larkspur.session import scratch_dir
from larkspur.sources import files as S
from larkspur.sources.load_log import LoggedTable
from larkspur.sources.versioned import VersionedTable
from larkspur.streaming.consume import Consumer, stream_table

CUSTOMER = T.StructType(
    [
        T.StructField("c_custkey", T.LongType()),
        T.StructField("c_name", T.StringType()),
        T.StructField("c_nationkey", T.IntegerType()),
        T.StructField("c_acctbal", T.DoubleType()),
        T.StructField("c_mktsegment", T.StringType()),
    ]
)
CUSTOMER_SQL = "SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment FROM customer"


def _staged(spark, df, label: str, **options) -> str:
    path = scratch_dir(spark, label)
    S.write_csv(df, path, **options)
    return path


def _customers(spark, sf):
    return D.table(spark, sf, "customer").select(*CUSTOMER.names)


@query("load_csv_fixed", CUSTOMER_SQL)
def load_csv_fixed(spark, sf):
    return S.read_csv(spark, _staged(spark, _customers(spark, sf), "customer"), CUSTOMER)


@query(
    "load_csv_options",
    "SELECT doc_id, text, lang, CASE WHEN lang <> 'fr' THEN source END AS source FROM documents",
)
def load_csv_options(spark, sf):
    """Semicolons, quotes, a NULL token, padded values and texts with line breaks; files are of bounded size, as they cannot be split."""
    docs = D.table(spark, sf, "documents").select(
        "doc_id",
        "text",
        F.concat(F.lit("  "), "lang").alias("lang"),
        F.when(F.col("lang") == "fr", "\\N").otherwise(F.col("source")).alias("source"),
    )
    path = _staged(spark, docs, "documents", max_records=100_000, sep=";", quoteAll=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    schema = "doc_id bigint, text string, lang string, source string"
    loaded = S.read_csv(spark, path, schema, sep=";", nullValue="\\N", multiLine=True)
    return loaded.withColumn("lang", F.trim("lang"))


@query(
    "load_csv_bytes",
    """SELECT doc_id, lang, CASE WHEN doc_id % 3 = 0 THEN source || chr(65533) || '(' WHEN doc_id % 3 = 1 THEN source || chr(65533) ELSE source END AS source FROM documents""",
)
def load_csv_bytes(spark, sf):
    """Files with bytes that are no UTF-8: a lead byte without its follower, a stray byte."""
    bad = F.when(F.col("doc_id") % 3 == 0, F.unhex(F.lit("C328"))).when(F.col("doc_id") % 3 == 1, F.unhex(F.lit("FF"))).otherwise(F.unhex(F.lit("")))
    line = F.concat(F.concat_ws("|", "doc_id", "lang", "source").cast("binary"), bad).cast("string")
    path = scratch_dir(spark, "bytes")
    D.table(spark, sf, "documents").select(line.alias("value")).write.text(path)
    return S.read_bytes(spark, path, "doc_id bigint, lang string, source string", sep="|")


@query(
    "load_csv_dates",
    """SELECT o_orderkey, d AS iso, d AS day_first, d AS month_first, d AS named, CASE WHEN o_orderkey % 3 <> 2 THEN d END AS mixed
FROM (SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS d FROM orders)""",
)
def load_csv_dates(spark, sf):
    """Date columns of unknown patterns, one of them mixed and with values that are no dates."""
    day, key = F.col("o_orderdate"), F.col("o_orderkey")
    mixed = F.when(key % 3 == 0, F.date_format(day, "yyyyMMdd")).when(key % 3 == 1, F.date_format(day, "dd.MM.yyyy")).otherwise("n/a")
    written = {"iso": "yyyy-MM-dd", "day_first": "dd/MM/yyyy", "month_first": "MM/dd/yyyy", "named": "dd-MMM-yyyy"}
    staged = D.table(spark, sf, "orders").select("o_orderkey", *[F.date_format(day, f).alias(n) for n, f in written.items()], mixed.alias("mixed"))
    columns = [*written, "mixed"]
    raw = S.read_csv(spark, _staged(spark, staged, "dates"), "o_orderkey bigint, " + ", ".join(f"{c} string" for c in columns))
    return S.parse_dates(raw, S.detect_dates(raw, columns))


@query("select_from_files", "SELECT 'part' AS kind, c_mktsegment AS segment, count(*) AS n, TRUE AS has_name FROM customer GROUP BY 2")
def select_from_files(spark, sf):
    """Positions instead of names, with the source file of every row."""
    path = _staged(spark, _customers(spark, sf), "positions", header=False)
    raw = S.select_files(spark, path)
    name = F.element_at(F.split("file_path", "/"), -1)
    return (
        raw.groupBy(F.col("_c4").alias("segment"))
        .agg(n_rows(), F.bool_and(name.startswith("part-")).alias("has_name"))
        .withColumn("kind", F.lit("part"))
    )


@query(
    "load_transform",
    "SELECT c_custkey AS id, c_name || ' / ' || c_mktsegment AS label, CAST(c_acctbal AS VARCHAR) AS balance_text, hex(encode(c_name)) AS name_hex FROM customer",
)
def load_transform(spark, sf):
    path = _staged(spark, _customers(spark, sf), "transform", header=False)
    raw = S.select_files(spark, path)
    return raw.select(
        F.col("_c0").cast("bigint").alias("id"),
        F.concat(F.col("_c1"), F.lit(" / "), F.col("_c4")).alias("label"),
        F.col("_c3").alias("balance_text"),
        F.hex(F.to_binary("_c1", F.lit("utf-8"))).alias("name_hex"),
    )


@query("load_truncate_columns", "SELECT c_custkey, left(c_name, 12) AS c_name, left(c_mktsegment, 4) AS c_mktsegment FROM customer")
def load_truncate_columns(spark, sf):
    loaded = S.read_csv(spark, _staged(spark, _customers(spark, sf), "widths"), CUSTOMER)
    return loaded.select(
        "c_custkey",
        S.fit_width(F.col("c_name"), 12, truncate=True).alias("c_name"),
        S.fit_width(F.col("c_mktsegment"), 4, truncate=True).alias("c_mktsegment"),
    )


def _with_bad_rows(spark, sf) -> str:
    """Customers in one folder per segment; HOUSEHOLD rows of rich customers carry text where a number belongs."""
    bad = (F.col("c_mktsegment") == "HOUSEHOLD") & (F.col("c_acctbal") > 9000)
    rows = _customers(spark, sf).withColumn(
        "c_acctbal", F.when(bad, "n/a").otherwise(F.col("c_acctbal").cast("string"))
    )
    rows = rows.withColumn("folder", F.col("c_mktsegment"))
    return _staged(spark, rows, "bad-rows", partition_by="folder")


def _tolerant(spark, sf):
    """The staged customers with their bad rows; the part files of a folder are one staged file."""
    rows = S.load_tolerant(spark, _with_bad_rows(spark, sf), CUSTOMER)
    return rows.withColumn("file_path", F.regexp_extract("file_path", "folder=([^/]+)", 1))


@query(
    "load_error_policy",
    """SELECT 'CONTINUE' AS policy, count(*) AS n FROM customer WHERE NOT (c_mktsegment = 'HOUSEHOLD' AND c_acctbal > 9000)
UNION ALL SELECT 'SKIP_FILE', count(*) FROM customer WHERE c_mktsegment <> 'HOUSEHOLD'""",
)
def load_error_policy(spark, sf):
    rows = _tolerant(spark, sf)
    parts = [
        S.on_error(rows, policy).agg(n_rows()).select(F.lit(policy).alias("policy"), "n") for policy in ("CONTINUE", "SKIP_FILE")
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


@query(
    "load_report",
    """SELECT c_mktsegment AS folder, CAST(count(*) AS BIGINT) AS rows_parsed, count(*) FILTER (NOT bad) AS rows_loaded, count(*) FILTER (bad) AS errors_seen,
  min(record) FILTER (bad) AS first_error, CASE WHEN count(*) FILTER (bad) = 0 THEN 'LOADED' ELSE 'PARTIALLY_LOADED' END AS status FROM
(SELECT *, c_mktsegment = 'HOUSEHOLD' AND c_acctbal > 9000 AS bad, c_custkey || ',' || c_name || ',' || c_nationkey || ',n/a,' || c_mktsegment AS record FROM customer) GROUP BY 1""",
)
def load_report(spark, sf):
    report = S.load_report(_tolerant(spark, sf))
    return report.select(F.col("file_path").alias("folder"), "rows_parsed", "rows_loaded", "errors_seen", "first_error", "status")


@query(
    "load_rejects",
    """SELECT c_mktsegment AS folder, c_custkey || ',' || c_name || ',' || c_nationkey || ',n/a,' || c_mktsegment AS rejected_record
FROM customer WHERE c_mktsegment = 'HOUSEHOLD' AND c_acctbal > 9000""",
)
def load_rejects(spark, sf):
    """Every rejected row of a load, with the file it stood in."""
    return S.rejects(_tolerant(spark, sf)).withColumnRenamed("file_path", "folder")


@query(
    "load_history",
    """SELECT CAST(run AS BIGINT) AS run, c_mktsegment AS folder, CAST(count(*) AS BIGINT) AS rows_parsed, count(*) FILTER (NOT bad) AS rows_loaded, count(*) FILTER (bad) AS errors_seen,
  min(record) FILTER (bad) AS first_error, CASE WHEN count(*) FILTER (bad) = 0 THEN 'LOADED' ELSE 'PARTIALLY_LOADED' END AS status, count(*) FILTER (NOT bad) AS rows_in_table, TRUE AS timed
FROM (SELECT *, c_mktsegment = 'HOUSEHOLD' AND c_acctbal > 9000 AS bad, c_custkey || ',' || c_name || ',' || c_nationkey || ',n/a,' || c_mktsegment AS record FROM customer), range(1, 3) r(run) GROUP BY 1, 2""",
)
def load_history(spark, sf):
    """Three loads of the same files: the second finds all of them logged and loads none, the third is forced."""
    folder, table = _with_bad_rows(spark, sf), LoggedTable.scratch(spark, "load-history", CUSTOMER)
    for force in (False, False, True):
        table.load(folder, force)
    status = F.when(F.sum("errors_seen") == 0, "LOADED").otherwise("PARTIALLY_LOADED")
    log = table.history().groupBy("run", F.regexp_extract("file_path", "folder=([^/]+)", 1).alias("folder")).agg(
        *[F.sum(c).alias(c) for c in ("rows_parsed", "rows_loaded", "errors_seen")],
        F.min("first_error").alias("first_error"),
        status.alias("status"),
        F.bool_and(F.col("loaded_at") >= F.col("last_modified")).alias("timed"),
    )
    held = table.rows().groupBy("run", F.col("c_mktsegment").alias("folder")).agg(n_rows("rows_in_table"))
    return log.join(held, ["run", "folder"])


@query("load_pattern", "SELECT c_custkey, c_name FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')")
def load_pattern(spark, sf):
    """Only the files whose path matches."""
    rows = _customers(spark, sf).withColumn("folder", F.col("c_mktsegment"))
    path = _staged(spark, rows, "pattern", partition_by="folder")
    loaded = S.read_csv(spark, path, CUSTOMER, pattern="*.csv")
    return loaded.filter(F.col("_metadata.file_path").rlike("folder=(BUILDING|MACHINERY)/")).select("c_custkey", "c_name")


@query(
    "load_json_parquet",
    """SELECT 'json' AS format, event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,4))) AS DOUBLE) AS total FROM events GROUP BY 2
UNION ALL SELECT 'parquet', event_type, count(*), CAST(sum(CAST(value AS DECIMAL(18,4))) AS DOUBLE) FROM events GROUP BY 2""",
)
def load_json_parquet(spark, sf):
    events = D.table(spark, sf, "events").select("event_id", "event_type", "value")
    json_path, parquet_path = scratch_dir(spark, "json"), scratch_dir(spark, "parquet")
    events.write.json(json_path)
    events.write.parquet(parquet_path)
    loaded = {
        "json": spark.read.schema(events.schema).json(json_path),
        "parquet": spark.read.schema(events.schema).parquet(parquet_path),
    }
    parts = [
        df.groupBy("event_type").agg(n_rows(), F.sum(D.dec("value")).alias("total")).withColumn("format", F.lit(name))
        for name, df in loaded.items()
    ]
    return parts[0].unionByName(parts[1])


@query(
    "infer_schema",
    """SELECT * FROM (VALUES (0, 'c_custkey', 'int'), (1, 'c_name', 'string'), (2, 'c_nationkey', 'int'), (3, 'c_acctbal', 'double'), (4, 'c_mktsegment', 'string'))
t(order_id, column_name, type) WHERE (SELECT count(*) FROM customer) > 0""",
)
def infer_schema(spark, sf):
    return S.infer_schema(spark, _staged(spark, _customers(spark, sf), "infer"))


@query(
    "list_files",
    """SELECT CAST(c_custkey // 5000 AS BIGINT) AS part, md5(string_agg(line || chr(10), '' ORDER BY c_custkey)) AS md5, CAST(sum(strlen(line) + 1) AS BIGINT) AS size, TRUE AS timed
FROM (SELECT c_custkey, c_custkey || '|' || c_name || '|' || c_mktsegment AS line FROM customer) GROUP BY 1""",
)
def list_files(spark, sf, whole: int = 100_000):
    """Staged files by size, digest and time; those above ``whole`` bytes are digested without being read into one row."""
    line = F.concat_ws("|", "c_custkey", "c_name", "c_mktsegment").alias("value")
    rows = _customers(spark, sf).select("c_custkey", line, F.expr("c_custkey div 5000").alias("part"))
    path = scratch_dir(spark, "listed")
    rows.repartition("part").sortWithinPartitions("part", "c_custkey").select("value", "part").write.partitionBy("part").text(path)
    part = F.regexp_extract("file_path", "part=([^/]+)/", 1).cast("bigint").alias("part")
    return S.list_files(spark, path, pattern="*.txt", whole=whole).select(part, "md5", "size", F.col("last_modified").isNotNull().alias("timed"))


@query("ctas", "SELECT customer_segment, country, count(*) AS n FROM v_customers GROUP BY 1, 2")
def ctas(spark, sf):
    """CREATE OR REPLACE TABLE ... AS: the second version replaces the first."""
    table = VersionedTable.scratch(spark, "ctas")
    table.write(D.customers(spark, sf).groupBy("customer_segment").agg(n_rows()))
    return table.write(D.customers(spark, sf).groupBy("customer_segment", "country").agg(n_rows()))


@query("append_sink", "SELECT order_status, count(*) AS n FROM v_orders GROUP BY 1")
def append_sink(spark, sf):
    orders = D.orders(spark, sf)
    done = F.col("order_status") == "COMPLETED"
    return S.append_table(spark, [orders.filter(done), orders.filter(~done)], "append").groupBy("order_status").agg(n_rows())


@query("overwrite_sink", "SELECT order_id, payment_method FROM v_orders WHERE order_status = 'PENDING'")
def overwrite_sink(spark, sf):
    path = scratch_dir(spark, "overwrite")
    kept = D.orders(spark, sf).select("order_id", "payment_method", "order_status")
    for rows in (kept, kept.filter("order_status = 'PENDING'")):
        rows.write.mode("overwrite").parquet(path)
    return spark.read.schema(kept.schema).parquet(path).drop("order_status")


@query(
    "insert_values",
    """SELECT customer_id, customer_name, customer_segment, country FROM v_customers UNION ALL
SELECT (SELECT max(customer_id) FROM v_customers) + i, name, segment, NULL FROM (VALUES (1, 'New Buyer', 'PREMIUM'), (2, 'Other Buyer', 'STANDARD')) t(i, name, segment)""",
)
def insert_values(spark, sf):
    """Literal rows added to a table; a column they lack is null, a defaulted one is filled."""
    base = D.customers(spark, sf).select("customer_id", "customer_name", "customer_segment", "country")
    top = base.agg(F.max("customer_id")).scalar()
    new = spark.createDataFrame([(1, "New Buyer", "PREMIUM"), (2, "Other Buyer", None)], "i bigint, customer_name string, customer_segment string")
    new = new.select(
        (F.col("i") + top).alias("customer_id"),
        "customer_name",
        F.coalesce("customer_segment", F.lit("STANDARD")).alias("customer_segment"),
    )
    return base.unionByName(new, allowMissingColumns=True)


@query("unload_csv", CUSTOMER_SQL + " WHERE TRUE")
def unload_csv(spark, sf, rows_per_file: int = 400):
    """CSV parts of limited size with header and quotes, read back."""
    path = _staged(spark, _customers(spark, sf), "unload", max_records=rows_per_file, quoteAll=True)
    return S.read_csv(spark, path, CUSTOMER)


@query("unload_partitioned", "SELECT c_mktsegment AS region, count(*) AS n, CAST(sum(c_custkey) AS BIGINT) AS keys FROM customer GROUP BY 1")
def unload_partitioned(spark, sf):
    rows = _customers(spark, sf).withColumn("region", F.col("c_mktsegment"))
    path = _staged(spark, rows, "by-region", partition_by="region")
    schema = T.StructType([*CUSTOMER.fields, T.StructField("region", T.StringType())])
    return S.read_csv(spark, path, schema).groupBy("region").agg(n_rows(), F.sum("c_custkey").alias("keys"))


@query(
    "continuous_file_ingest",
    "SELECT event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,4))) AS DOUBLE) AS total FROM events GROUP BY 1",
)
def continuous_file_ingest(spark, sf):
    """Existing files are back-filled, files that arrive later are loaded once."""
    events = D.table(spark, sf, "events").select("event_id", "event_type", "value")
    path = scratch_dir(spark, "arrivals")
    consumer = Consumer.scratch(spark, "ingest")
    late = F.col("event_type").isin("error", "purchase")
    for part in (events.filter(~late), events.filter(late)):
        part.write.mode("append").option("header", True).csv(path)
        consumer.run(stream_table(spark, path, events.schema, fmt="csv", header=True), lambda batch: batch)
    return consumer.result().groupBy("event_type").agg(n_rows(), F.sum(D.dec("value")).alias("total"))


@query(
    "ingest_forced",
    "SELECT event_type, 2 * count(*) AS n FROM events GROUP BY 1",
)
def ingest_forced(spark, sf):
    """A forced reload: a second consumer state loads the same files again into the same table."""
    events = D.table(spark, sf, "events").select("event_id", "event_type")
    path, sink = scratch_dir(spark, "forced"), scratch_dir(spark, "forced-table")
    events.write.parquet(path)
    for run in (1, 2):
        loader = Consumer(spark, f"{sink}/run={run}", scratch_dir(spark, f"forced-state-{run}"))
        loader.run(stream_table(spark, path, events.schema), lambda batch: batch)
    return spark.read.option("basePath", sink).parquet(f"{sink}/run=*").groupBy("event_type").agg(n_rows())


@query(
    "ingest_purge",
    """SELECT event_type, count(*) AS n, count(*) FILTER (event_type IN ('error', 'purchase')) AS loaded_late, TRUE AS late_files_kept, CAST(0 AS BIGINT) AS files_left FROM events GROUP BY 1""",
)
def ingest_purge(spark, sf):
    """Staged files are deleted once they are loaded; one that arrives between load and purge stays and is loaded next."""
    events = D.table(spark, sf, "events").select("event_id", "event_type")
    path, late = scratch_dir(spark, "purged"), F.col("event_type").isin("error", "purchase")
    loader = Consumer.scratch(spark, "purge")

    def files_left() -> int:
        return S.list_files(spark, path, with_md5=False, pattern="*.parquet").agg(n_rows("n")).first()["n"]

    events.filter(~late).write.parquet(path)
    loader.run(stream_table(spark, path, events.schema), lambda batch: batch)
    loaded = files_left()
    events.filter(late).write.mode("append").parquet(path)
    arrived = files_left() - loaded
    loader.purge()
    kept = files_left() == arrived > 0
    loader.run(stream_table(spark, path, events.schema), lambda batch: batch)
    loader.purge()
    rows = loader.result().groupBy("event_type").agg(n_rows(), F.count_if(F.col("batch_id") > 0).alias("loaded_late"))
    return rows.withColumns({"late_files_kept": F.lit(kept), "files_left": F.lit(files_left()).cast("long")})


ZIPF_RANKS = 10


@query("random_columns")
def random_columns(spark, sf, seed: int = 42):
    """Uniform, normal, Zipf and UUID columns beside each customer."""
    weights = [1.0 / k for k in range(1, ZIPF_RANKS + 1)]
    total, run, edges = sum(weights), 0.0, []
    for w in weights:
        run += w / total
        edges.append(run)
    u = F.rand(seed + 2)
    rows = _customers(spark, sf).select("c_custkey", F.rand(seed).alias("uniform"), F.randn(seed + 1).alias("normal"), u.alias("u"))
    below = F.size(F.filter(F.array(*[F.lit(e) for e in edges[:-1]]), lambda e: e < F.col("u")))
    return rows.select("c_custkey", "uniform", "normal", (below + 1).alias("zipf"), F.expr("uuid()").alias("id"))
