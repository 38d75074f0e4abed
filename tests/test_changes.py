"""Change logs, upserts and versioned dimensions on small frames."""

from datetime import date, datetime

from pyspark.sql import functions as F

from larkspur.operators import changes as C
from larkspur.operators import merge as M
from larkspur.sources.partitioned import PartitionedTable
from larkspur.sources.versioned import VersionedTable

LOG = "key int, commit_ts timestamp_ntz, commit_id bigint, step int, action string, is_update boolean, payload int"


def log(spark, rows):
    return spark.createDataFrame([(k, datetime(2024, 1, d), d, s, a, u, p) for k, d, s, a, u, p in rows], LOG)


def as_set(df):
    return {tuple(r) for r in df.collect()}


def test_diff(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "d")], "k int, v string")
    new = spark.createDataFrame([(2, "b"), (3, "c"), (4, None), (5, "e")], "k int, v string")
    got = as_set(C.diff_states(old, new, ["k"], ["v"]).drop("row_id"))
    assert got == {
        (1, "DELETE", False, "a"),
        (3, "DELETE", True, None),
        (3, "INSERT", True, "c"),
        (4, "DELETE", True, "d"),
        (4, "INSERT", True, None),
        (5, "INSERT", False, "e"),
    }


def test_net_of_insert_then_delete_is_nothing(spark):
    changes = log(
        spark,
        [
            (1, 1, 1, "INSERT", False, 10),
            (1, 2, 0, "DELETE", False, 10),
            (2, 1, 1, "INSERT", False, 20),
            (2, 2, 0, "DELETE", True, 20),
            (2, 2, 1, "INSERT", True, 21),
            (3, 1, 0, "DELETE", False, 30),
            (3, 2, 1, "INSERT", False, 31),
            (4, 1, 0, "DELETE", False, 40),
        ],
    )
    got = as_set(C.net_changes(changes, "key", ["payload"]))
    assert got == {
        (2, "INSERT", False, 21),
        (3, "DELETE", True, 30),
        (3, "INSERT", True, 31),
        (4, "DELETE", False, 40),
    }


def test_snapshot(spark):
    changes = log(
        spark,
        [(1, 1, 1, "INSERT", False, 10), (1, 3, 0, "DELETE", True, 10), (1, 3, 1, "INSERT", True, 11), (2, 1, 1, "INSERT", False, 20), (2, 2, 0, "DELETE", False, 20)],
    )
    assert as_set(C.snapshot_as_of(changes, "key", ["payload"], datetime(2024, 1, 2))) == {(1, 10)}
    assert as_set(C.snapshot_as_of(changes, "key", ["payload"], datetime(2024, 1, 1))) == {(1, 10), (2, 20)}
    assert as_set(C.snapshot_as_of(changes, "key", ["payload"], datetime(2024, 1, 9))) == {(1, 11)}


def test_diff_then_replay(spark):
    old = spark.range(100).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    new = spark.range(50, 150).select(F.col("id").alias("k"), (F.col("id") % 5).alias("v"))
    diff = C.diff_states(old, new, ["k"], ["v"])
    replay = diff.select(
        F.col("k").alias("key"),
        F.lit(datetime(2024, 1, 2)).cast("timestamp_ntz").alias("commit_ts"),
        F.lit(2).alias("commit_id"),
        (F.col("action") == "INSERT").cast("int").alias("step"),
        "action",
        F.col("v").alias("payload"),
    )
    base = old.select(
        F.col("k").alias("key"),
        F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz").alias("commit_ts"),
        F.lit(1).alias("commit_id"),
        F.lit(1).alias("step"),
        F.lit("INSERT").alias("action"),
        F.col("v").alias("payload"),
    )
    state = C.snapshot_as_of(base.unionByName(replay), "key", ["payload"], datetime(2024, 1, 3))
    assert as_set(state) == as_set(new)


def test_update_and_delete_with_unknown_conditions(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 50)], "k int, v int")
    assert as_set(M.update_where(df, F.col("v") > 10, {"v": F.lit(0)})) == {(1, 5), (2, None), (3, 0)}
    assert as_set(M.delete_where(df, F.col("v") > 10)) == {(1, 5), (2, None)}


def test_merge(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    source = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    assert as_set(M.merge_upsert(target, source, ["k"])) == {(1, "a"), (2, "B"), (3, "C")}


DIM = "sk bigint, k bigint, v string, effective_date date, end_date date, is_current boolean"
OPEN = date(9999, 12, 31)


def scd2(spark, dim, now, as_of):
    current = dim.filter("is_current").select("k", "v")
    diff = C.diff_states(current, now, ["k"], ["v"])
    return M.scd2_apply(dim, diff, "k", "sk", ["v"], as_of)


def test_scd2_two_runs(spark):
    start = date(2024, 1, 1)
    dim = spark.createDataFrame([(1, 1, "a", start, OPEN, True), (2, 2, "b", start, OPEN, True)], DIM)
    now = spark.createDataFrame([(1, "A"), (2, "b"), (3, "c")], "k bigint, v string")
    once = scd2(spark, dim, now, date(2024, 2, 1))
    assert as_set(once) == {
        (1, 1, "a", start, date(2024, 1, 31), False),
        (2, 2, "b", start, OPEN, True),
        (3, 1, "A", date(2024, 2, 1), OPEN, True),
        (4, 3, "c", date(2024, 2, 1), OPEN, True),
    }
    assert as_set(scd2(spark, once, now, date(2024, 3, 1))) == as_set(once)
    third = scd2(spark, once, now.withColumn("v", F.upper("v")), date(2024, 3, 1))
    per_key = third.groupBy("k").agg(F.count_if("is_current").alias("c"), F.count(F.lit(1)).alias("n"))
    assert {tuple(r) for r in per_key.collect()} == {(1, 1, 2), (2, 1, 2), (3, 1, 2)}
    assert third.select("sk").distinct().count() == third.count()
    overlap = third.alias("a").join(third.alias("b"), (F.col("a.k") == F.col("b.k")) & (F.col("a.sk") < F.col("b.sk")))
    assert overlap.filter(F.col("a.end_date") >= F.col("b.effective_date")).count() == 0


def test_versions(spark):
    table = VersionedTable.scratch(spark, "versions")
    assert table.version() == 0
    one = table.write(spark.range(3))
    two = table.write(one.filter("id > 0"))  # rewrites what it reads
    assert (one.count(), two.count(), table.version(), table.read(1).count()) == (3, 2, 2, 3)


def test_rewrite_leaves_other_files(spark):
    table = VersionedTable.scratch(spark, "t-files")
    table.write(spark.range(100).select("id", (F.col("id") % 7).alias("v")).repartitionByRange(5, "id"))
    before = set(table.files())
    hit = F.col("id") == 41
    out = table.rewrite(hit, lambda rows: M.update_where(rows, hit, {"v": F.lit(99)}))
    assert as_set(out) == {(i, 99 if i == 41 else i % 7) for i in range(100)}
    assert len(before & set(table.files())) == len(before) - 1
    assert as_set(table.read(1)) == {(i, i % 7) for i in range(100)}  # the old version is still there
    assert table.rewrite(F.col("id") == 1000, lambda rows: rows).count() == 100 and table.version() == 2
    gone = table.rewrite(F.col("id") >= 0, lambda rows: M.delete_where(rows, F.col("id") >= 0))
    assert gone.columns == ["id", "v"] and gone.count() == 0


def test_rewrite_is_done_again_after_a_break(spark):
    table = VersionedTable.scratch(spark, "t-again")
    table.write(spark.range(10).repartitionByRange(2, "id"))
    # files of a rewrite that broke before it was published
    spark.range(500, 600).write.parquet(f"{table.path}/data/v00000002")
    assert table.version() == 1 and table.read().count() == 10
    hit = F.col("id") < 3
    assert as_set(table.rewrite(hit, lambda rows: M.delete_where(rows, hit))) == {(i,) for i in range(3, 10)}


def month_table(spark, label):
    table = PartitionedTable.scratch(spark, label, "month", F.date_format("day", "yyyy-MM"))
    days = spark.sql("SELECT explode(sequence(date'2024-01-01', date'2024-06-30')) AS day").withColumn("v", F.lit(1))
    return table, days


def month_files(spark, table):
    return {m: {r["f"] for r in g} for m, g in _grouped(table.read(True).select("month", F.col("_metadata.file_path").alias("f")).distinct().collect())}


def _grouped(found):
    out = {}
    for r in found:
        out.setdefault(r["month"], []).append(r)
    return out.items()


def test_merge_writes_touched_months_only(spark):
    table, days = month_table(spark, "t-months")
    table.merge(days, ["day"])  # into nothing: the source alone
    before = month_files(spark, table)
    source = spark.createDataFrame([(date(2024, 3, 5), 7), (date(2024, 9, 1), 8)], "day date, v int")
    out = {r["day"]: r["v"] for r in table.merge(source, ["day"]).collect()}
    assert len(out) == 183 and out[date(2024, 3, 5)] == 7 and out[date(2024, 9, 1)] == 8 and sum(out.values()) == 181 + 15
    after = month_files(spark, table)
    assert {m for m in after if after[m] != before.get(m)} == {"2024-03", "2024-09"}
    assert sorted(map(str, table.merge(source.limit(0), ["day"]).select("day").collect())) == sorted(map(str, table.read().select("day").collect()))


def test_retention_drops_whole_months(spark):
    table, days = month_table(spark, "t-retain")
    table.write(days)
    before = month_files(spark, table)
    cut = F.lit(date(2024, 3, 10))
    kept = table.retain(F.col("day") >= cut, F.date_format(cut, "yyyy-MM"))
    assert {r["day"] for r in kept.collect()} == {r["day"] for r in days.collect() if r["day"] >= date(2024, 3, 10)}
    after = month_files(spark, table)
    assert set(after) == {"2024-03", "2024-04", "2024-05", "2024-06"}
    assert {m for m in after if after[m] != before[m]} == {"2024-03"}
    first = F.lit(date(2024, 4, 1))
    table.retain(F.col("day") >= first, F.date_format(first, "yyyy-MM"))
    assert month_files(spark, table)["2024-05"] == before["2024-05"]
