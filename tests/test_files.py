"""Staged files: options, error policies, widths, size limits, ingest."""

import gzip
import hashlib
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.session import scratch_dir
from larkspur.sources import files as S
from larkspur.sources.load_log import LoggedTable
from larkspur.streaming.consume import Consumer, stream_table

SCHEMA = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType()), T.StructField("amount", T.DoubleType())])


def text_file(spark, path, name_lines):
    """Write lines as they are, one file."""
    spark.createDataFrame([(line,) for line in name_lines], "value string").coalesce(1).write.mode("append").text(path)


@pytest.fixture(scope="module")
def mixed(spark):
    path = scratch_dir(spark, "t-mixed")
    text_file(spark, path, ["id,name,amount", "1,a,1.5", "2,b,oops", "x,c,3.5"])
    text_file(spark, path, ["id,name,amount", "4,d,4.5", "5,e,5.5"])
    return path


def test_policies(spark, mixed):
    rows = S.load_tolerant(spark, mixed, SCHEMA)
    assert S.on_error(rows, "CONTINUE").count() == 3
    assert {r.id for r in S.on_error(rows, "SKIP_FILE").collect()} == {4, 5}
    assert {r.id for r in S.on_error(rows, "SKIP_FILE", limit=2).collect()} == {1, 4, 5}
    with pytest.raises(PySparkException):
        S.on_error(rows, "ABORT").collect()


def test_bad_rows_do_not_depend_on_columns_read(spark, mixed):
    rows = S.load_tolerant(spark, mixed, SCHEMA)
    assert rows.filter(F.col(S.CORRUPT).isNotNull()).select("name").count() == 2


def test_report(spark, mixed):
    report = {r.status: (r.rows_parsed, r.rows_loaded, r.errors_seen) for r in S.load_report(S.load_tolerant(spark, mixed, SCHEMA)).collect()}
    assert report == {"PARTIALLY_LOADED": (3, 1, 2), "LOADED": (2, 2, 0)}


def test_options(spark):
    path = scratch_dir(spark, "t-options")
    text_file(spark, path, ["id|name|amount", "1| padded |2.5", '2|"a|b"|NULL', "3||1.0"])
    got = S.read_csv(spark, path, SCHEMA, sep="|").orderBy("id").collect()
    assert [tuple(r) for r in got] == [(1, "padded", 2.5), (2, "a|b", None), (3, None, 1.0)]


def test_width(spark):
    df = spark.createDataFrame([("abcdef",), ("ab",)], "v string")
    assert [r[0] for r in df.select(S.fit_width(F.col("v"), 3, True)).collect()] == ["abc", "ab"]
    with pytest.raises(PySparkException):
        df.select(S.fit_width(F.col("v"), 3, False)).collect()


def test_unload_splits_files(spark):
    path = scratch_dir(spark, "t-unload")
    S.write_csv(spark.range(100).coalesce(1), path, max_records=30)
    assert S.list_files(spark, path, pattern="*.csv").count() == 4
    assert S.read_csv(spark, path, "id bigint").agg(F.sum("id")).first()[0] == 4950


def test_inferred_types(spark):
    path = scratch_dir(spark, "t-infer")
    text_file(spark, path, ["a,b,c,d", "1,x,2.5,2024-01-01", "2,y,3.5,2024-01-02"])
    got = [(r.column_name, r.type) for r in S.infer_schema(spark, path).orderBy("order_id").collect()]
    assert got == [("a", "int"), ("b", "string"), ("c", "double"), ("d", "date")]


def test_force_reload_is_a_new_checkpoint(spark):
    path = scratch_dir(spark, "t-force")
    spark.range(5).write.csv(path)
    schema = spark.range(1).schema
    first, again = Consumer.scratch(spark, "t-first"), Consumer.scratch(spark, "t-again")
    for consumer in (first, first, again):
        consumer.run(stream_table(spark, path, schema, fmt="csv"), lambda b: b)
    assert (first.result().count(), again.result().count()) == (5, 5)


def test_log_decides_what_is_loaded(spark):
    path = scratch_dir(spark, "t-logged")
    text_file(spark, path, ["id,name,amount", "1,a,1.5", "2,b,oops"])
    table = LoggedTable.scratch(spark, "t-log", SCHEMA)
    assert table.history().collect() == [] and table.rows().collect() == []
    assert table.load(path) == 1 and table.load(path) is None
    text_file(spark, path, ["id,name,amount", "3,c,3.5"])
    assert table.load(path) == 2  # the new file only
    again = LoggedTable(spark, table.path, table.log, SCHEMA)
    assert again.load(path) is None and again.load(path, force=True) == 3
    assert sorted((r["run"], r["id"]) for r in again.rows().collect()) == [(1, 1), (2, 3), (3, 1), (3, 3)]
    logged = sorted((r["run"], r["rows_parsed"], r["rows_loaded"], r["first_error"], r["status"]) for r in again.history().collect())
    assert logged == [(1, 2, 1, "2,b,oops", "PARTIALLY_LOADED"), (2, 1, 1, None, "LOADED"), (3, 1, 1, None, "LOADED"), (3, 2, 1, "2,b,oops", "PARTIALLY_LOADED")]
    assert all(r["loaded_at"] >= r["last_modified"] for r in again.history().collect())


def test_replaced_and_empty_files(spark, tmp_path):
    file = tmp_path / "in [1].csv"
    file.write_text("id,name,amount\n1,a,1.0\n")
    (tmp_path / "none.csv").write_text("id,name,amount\n")
    table = LoggedTable.scratch(spark, "t-replaced", SCHEMA)
    assert table.load(str(tmp_path)) == 1
    file.write_text("id,name,amount\n2,b,2.0\n")
    assert table.load(str(tmp_path)) == 2 and table.load(str(tmp_path)) is None
    assert sorted((r["run"], r["id"]) for r in table.rows().collect()) == [(1, 1), (2, 2)]
    assert sorted((r["run"], r["rows_parsed"], r["status"]) for r in table.history().collect()) == [(1, 0, "LOADED"), (1, 1, "LOADED"), (2, 1, "LOADED")]


def test_broken_load_starts_over(spark):
    path = scratch_dir(spark, "t-broken")
    text_file(spark, path, ["id,name,amount", "1,a,1.5"])
    table = LoggedTable.scratch(spark, "t-broken-log", SCHEMA)
    # rows of a run that was never logged
    spark.createDataFrame([(9, "x", 9.0)], SCHEMA).write.parquet(f"{table.path}/run=1")
    assert table.load(path) == 1
    assert [r["id"] for r in table.rows().collect()] == [1]


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_digests_by_row_and_by_line(spark, tmp_path, limit):
    contents = {
        "plain.txt": b"a\nbb\n\nccc\n",
        "no last break": b"a\nbb",
        "one break": b"\n",
        "breaks": b"\n\n\n",
        "windows": b"a\r\nb\r\n",
        "mark": b"\xef\xbb\xbfa\nb\n",
        "mark only line": b"\xef\xbb\xbfa",
        "bytes": bytes(range(256)) * 300,
        "packed.gz": gzip.compress(b"a\nb\n"),
        "long": b"x" * 300_000 + b"\n" + b"y" * 10,
    }
    for name, data in contents.items():
        (tmp_path / name).write_bytes(data)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        got = {os.path.basename(r["path"]): (r["size"], r["md5"]) for r in S.list_files(spark, str(tmp_path), whole=limit).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {n: (len(d), hashlib.md5(d).hexdigest()) for n, d in contents.items()}


def test_bytes_that_are_no_utf8(spark, tmp_path):
    (tmp_path / "f.csv").write_bytes(b"1|a\xff|2.0\n2|ok\xc3\xa9|3.0\n3|\xe2\x82|4.0\n")
    read = lambda how: [tuple(r) for r in S.read_bytes(spark, str(tmp_path), "id int, name string, amount double", how, sep="|").orderBy("id").collect()]
    assert read("replace") == [(1, "a\ufffd", 2.0), (2, "ok\xe9", 3.0), (3, "\ufffd", 4.0)]
    assert read("skip") == [(2, "ok\xe9", 3.0)]
    with pytest.raises(PySparkException):
        read("error")


def test_date_patterns_are_voted(spark):
    rows = [("13/01/2024", "01/13/2024", "x"), ("02/03/2024", "03/02/2024", None), ("2024-05-06", "02/29/2023", "")]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    found = S.detect_dates(df, ["a", "b", "c"])
    assert found == {"a": ["dd/MM/yyyy", "yyyy-MM-dd", "MM/dd/yyyy"], "b": ["MM/dd/yyyy", "dd/MM/yyyy"], "c": []}
    got = [tuple(map(str, r)) for r in S.parse_dates(df, found).collect()]
    assert got == [("2024-01-13", "2024-01-13", "None"), ("2024-03-02", "2024-03-02", "None"), ("2024-05-06", "None", "None")]
