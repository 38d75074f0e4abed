"""Streams over several files: equal to the batch result, and once only."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from larkspur import domain as D
from larkspur.plans import datasets as P
from larkspur.plans import streams
from larkspur.plans.streams import city_totals
from larkspur.registry import callables
from larkspur.session import scratch_dir
from larkspur.streaming.consume import Consumer, append_stream, daily_parts, daily_totals, lookback_parts, lookback_totals, once, stream_table
from larkspur.streaming.consume import committed_files
from larkspur.streaming.partials import PartialTable
from larkspur.streaming.refresh import RefreshedTable


@pytest.fixture(scope="module")
def orders(spark, small):
    return D.table(spark, small, "orders")


def drop_files(df, path, parts):
    for cond in parts:
        df.filter(cond).coalesce(1).write.mode("append").parquet(path)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_consumer_takes_each_file_once(spark, small, orders):
    path = scratch_dir(spark, "t-orders")
    consumer = Consumer.scratch(spark, "t-city")
    half = F.col("o_orderkey") % 2 == 0
    stream = lambda: stream_table(spark, path, orders.schema, max_files=1)
    drop_files(orders, path, [half])
    assert consumer.run(stream(), city_totals(spark, small, P.CITY)) == 1
    assert consumer.run(stream(), city_totals(spark, small, P.CITY)) == 0
    drop_files(orders, path, [~half])
    assert consumer.run(stream(), city_totals(spark, small, P.CITY)) == 1
    got = consumer.result().groupBy("date").agg(F.sum("total_sales").cast("double"))
    want = P.city_orders(spark, small).filter(F.col("city_name") == P.CITY).select("date", F.col("order_total").cast("double"))
    assert rows(got) == rows(want)


def test_replayed_batch_leaves_one_copy(spark):
    consumer = Consumer.scratch(spark, "t-replay")
    path = scratch_dir(spark, "t-replay-in")
    spark.range(10).write.parquet(path)
    schema = spark.range(1).schema
    consumer.run(stream_table(spark, path, schema), lambda b: b)
    # the same batch number again, as after a failure before the commit
    spark.range(10).write.mode("overwrite").parquet(f"{consumer.sink}/batch_id=0")
    assert consumer.result().count() == 10


def test_two_consumers_do_not_share_offsets(spark):
    path = scratch_dir(spark, "t-shared")
    spark.range(10).write.parquet(path)
    schema = spark.range(1).schema
    counts = []
    for name in ("t-a", "t-b"):
        consumer = Consumer.scratch(spark, name)
        consumer.run(stream_table(spark, path, schema), lambda b: b)
        counts.append(consumer.result().count())
    assert counts == [10, 10]


def test_refresh_follows_late_rows(spark):
    path = scratch_dir(spark, "t-base")
    schema = "day date, amount bigint"
    day = lambda n: datetime(2024, 1, n).date()

    def add(data):
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(path)

    def compute(keys):
        base = spark.read.schema(schema).parquet(path)
        return base.join(keys, "day", "left_semi").groupBy("day").agg(F.sum("amount").alias("amount"))

    table = RefreshedTable.scratch(spark, ["day"], lambda b: b.select("day").distinct(), compute, "t-refresh")
    struct = spark.createDataFrame([], schema).schema
    add([(day(1), 1), (day(2), 2)])
    assert table.refresh(stream_table(spark, path, struct)) == 1
    add([(day(1), 10), (day(3), 3)])  # a late row for a closed day
    assert table.refresh(stream_table(spark, path, struct)) == 1
    assert table.refresh(stream_table(spark, path, struct)) == 0
    assert rows(table.read()) == [(day(1), 11), (day(2), 2), (day(3), 3)]


def test_refresh_removes_keys_and_goes_on_after_a_restart(spark):
    path, table, state = (scratch_dir(spark, f"t-restart{i}") for i in range(3))
    schema = "day bigint, amount bigint, gone boolean"

    def add(data):
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(path)

    def compute(keys):
        base = spark.read.schema(schema).parquet(path)
        dead = base.filter("gone").select("day")
        return base.join(keys, "day", "left_semi").join(dead, "day", "left_anti").select("day", "amount")

    def fresh():
        return RefreshedTable(spark, ["day"], lambda b: b.select("day").distinct(), compute, table, state)

    struct = spark.createDataFrame([], schema).schema
    add([(1, 1, False), (1, 5, False), (2, 2, False)])
    fresh().refresh(stream_table(spark, path, struct))
    add([(2, 0, True), (3, 3, False)])
    assert fresh().refresh(stream_table(spark, path, struct)) == 1
    assert fresh().refresh(stream_table(spark, path, struct)) == 0
    assert rows(fresh().read()) == [(1, 1), (1, 5), (3, 3)]


def test_consumer_goes_on_after_a_restart(spark):
    path, sink, state = (scratch_dir(spark, f"t-again{i}") for i in range(3))
    spark.range(10).write.parquet(path)
    schema = spark.range(1).schema
    Consumer(spark, sink, state).run(stream_table(spark, path, schema), lambda b: b)
    again = Consumer(spark, sink, state)
    assert again.result().count() == 10
    assert again.run(stream_table(spark, path, schema), lambda b: b) == 0
    assert again.result().count() == 10


@pytest.fixture(scope="module")
def clicks(spark):
    start = datetime(2024, 1, 1)
    data = [(i, start + timedelta(minutes=37 * i), i % 5) for i in range(400)]
    return spark.createDataFrame(data, "id bigint, ts timestamp_ntz, v bigint").cache()


def arrival(spark, df, files: int, order: str) -> str:
    """The rows in so many files by time, written (and so delivered) in the given order."""
    path = scratch_dir(spark, f"t-files-{files}-{order}")
    parts = list(range(files))
    parts = {"oldest": parts, "newest": parts[::-1], "mixed": sorted(parts, key=lambda p: p * 7 % 11)}[order]
    for p in parts:
        df.filter(f"id div {-(-400 // files)} = {p}").coalesce(1).write.mode("append").parquet(path)
    return path


@pytest.mark.parametrize("files,order", [(1, "oldest"), (4, "oldest"), (4, "newest"), (40, "mixed")])
def test_windows_equal_batch_whatever_the_files(spark, clicks, files, order):
    path = arrival(spark, clicks, files, order)
    stream = lambda: stream_table(spark, path, clicks.schema, max_files=max(files // 4, 1))
    days, looks = Consumer.scratch(spark, "t-days"), Consumer.scratch(spark, "t-looks")
    days.run(stream(), lambda b: daily_parts(b, "ts", "v"))
    looks.run(stream(), lambda b: lookback_parts(b, "ts", "1 hour", "15 minutes"))
    assert len(days.batches) >= min(files, 4)
    assert rows(daily_totals(days.result())) == rows(daily_parts(clicks, "ts", "v"))
    assert rows(lookback_totals(looks.result())) == rows(lookback_parts(clicks, "ts", "1 hour", "15 minutes"))


@pytest.mark.parametrize("order", ["oldest", "newest"])
def test_redelivery_counts_once_however_late(spark, clicks, order):
    path = arrival(spark, clicks, 4, order)
    clicks.coalesce(1).write.mode("append").parquet(path)
    stream = stream_table(spark, path, clicks.schema, max_files=1)
    assert append_stream(once(stream, ["id"]), "t-once").count() == 400


FOLLOWERS = "city_sales_incremental city_sales_live consume_changes_once dynamic_table_refresh stream_daily_window stream_lookback stream_dedup_once".split()


@pytest.fixture(scope="module")
def folders(spark, small, tmp_path_factory):
    """The small tables with orders and events as folders of part files."""
    out = tmp_path_factory.mktemp("tables")
    for name in "region nation customer supplier part lineitem orders events".split():
        parts = {"orders": 4, "events": 9}.get(name, 1)
        spark.read.parquet(f"{small}/{name}.parquet").repartition(parts).write.parquet(f"{out}/{name}.parquet")
    return str(out)


@pytest.mark.parametrize("key", FOLLOWERS)
def test_folder_tables_give_the_same_rows(spark, small, folders, key):
    fn = callables()[key]
    assert rows(fn(spark, folders)) == rows(fn(spark, small))


def test_summaries_follow_several_batches(spark, folders, monkeypatch):
    """Distinct counts stay exact when the orders come in four batches."""
    follow = streams.follow
    monkeypatch.setattr(streams, "stream_table", lambda *a, **k: stream_table(*a, **{**k, "max_files": 1}))
    assert follow is streams.follow
    for live, whole in (("brand_sales_live", "daily_sales_by_brand"), ("regional_sales_live", "regional_sales"), ("menu_item_performance_live", "menu_item_performance"), ("customer_activity_live", "customer_activity")):
        a, b = callables()[live](spark, folders), callables()[whole](spark, folders)
        assert a.select(b.columns).exceptAll(b).isEmpty() and a.count() == b.count()


MOVES = "day string, who bigint, amount bigint, sign int"


def moves_partial(batch):
    sign = F.col("sign").cast("bigint")
    return batch.select("day", "who", (F.col("amount") * sign).alias("amount"), sign.alias("n"), F.col("amount").alias("top"))


def moves_stream(spark, path, max_files=None):
    return stream_table(spark, path, spark.createDataFrame([], MOVES).schema, max_files=max_files)


@pytest.mark.parametrize("bound", [1, 32])
def test_partials_retract_compact_and_restart(spark, bound):
    """Distinct counts are exact after retractions, null keys are keys, and late rows reach closed days."""
    src, path, state = (scratch_dir(spark, f"t-partial{i}") for i in range(3))

    def table():
        return PartialTable(spark, ["day", "who"], ["amount", "n"], path, state, ["top"], bound=bound)

    batches = [
        [("a", 1, 5, 1), ("a", 1, 6, 1), ("a", 2, 7, 1), (None, None, 1, 1)],
        [("b", 1, 1, 1), ("a", 1, 5, -1)],
        [("a", 1, 6, -1), ("a", 3, 2, 1), (None, None, 2, 1)],
        [("b", 1, 1, -1)],
    ]
    for rows_ in batches:
        spark.createDataFrame(rows_, MOVES).coalesce(1).write.mode("append").parquet(src)
        assert table().refresh(moves_stream(spark, src), moves_partial) == 1
    assert table().refresh(moves_stream(spark, src), moves_partial) == 0
    got = table().read().groupBy("day").agg(F.count("who").alias("people"), F.sum("amount").alias("amount")).collect()
    assert {tuple(r) for r in got} == {("a", 2, 9), (None, 0, 3)}
    assert len(table()._live()[1]) <= bound + 1


def test_partials_replay_leaves_one_copy(spark):
    src = scratch_dir(spark, "t-partial-src")
    spark.createDataFrame([("a", 1, 5, 1)], MOVES).coalesce(1).write.parquet(src)
    table = PartialTable.scratch(spark, "t-partial-replay", ["day", "who"], ["amount", "n"])
    table.refresh(moves_stream(spark, src), moves_partial)
    # the same batch again, as after a failure before its commit
    table.fold(moves_partial(spark.read.schema(MOVES).parquet(src))).write.mode("overwrite").parquet(f"{table.path}/parts/batch_id=0")
    assert [r["amount"] for r in table.read().collect()] == [5]


@pytest.mark.parametrize("files,each", [(1, 1), (4, 1), (40, 10)])
def test_summary_equals_batch_whatever_the_files(spark, small, tmp_path_factory, monkeypatch, files, each):
    """Orders and lines in any number of files, lines often before their orders; a batch scans neither table."""
    out = tmp_path_factory.mktemp(f"split{files}")
    for name in "region nation customer supplier part lineitem orders".split():
        split = {"orders": (files, "o_orderkey"), "lineitem": (files, "l_partkey")}.get(name)
        df = spark.read.parquet(f"{small}/{name}.parquet")
        (df.repartition(*split) if split else df.coalesce(1)).write.parquet(f"{out}/{name}.parquet")
    plans = []
    fold = PartialTable.fold

    def watched(self, rows_):
        plans.append(rows_._jdf.queryExecution().optimizedPlan().toString())
        return fold(self, rows_)

    monkeypatch.setattr(PartialTable, "fold", watched)
    monkeypatch.setattr(streams, "stream_table", lambda *a, **k: stream_table(*a, **{**k, "max_files": each}))
    got = rows(callables()["dynamic_table_refresh"](spark, str(out)).select("summary_date", "total_orders", "unique_customers", "total_revenue", "total_profit", "total_quantity"))
    want = rows(callables()["daily_sales_summary"](spark, small).select("summary_date", "total_orders", "unique_customers", "total_revenue", "total_profit", "total_quantity"))
    assert got == want
    for plan in plans[:-1]:
        # columns of the two tables come from the batch only, which is no file relation
        scans = [line for line in plan.split("\n") if "Relation" in line]
        assert scans and not any("o_orderkey" in s or "l_orderkey" in s for s in scans)


def test_state_of_streams_is_on_disk(spark):
    spark_conf = "spark.sql.streaming.stateStore.providerClass"
    callables()  # a query configures its session
    from larkspur.session import configure

    assert "RocksDB" in configure(spark).conf.get(spark_conf)
    src, state, sink = (scratch_dir(spark, f"t-rocks{i}") for i in range(3))

    def run():
        stream = once(stream_table(spark, src, spark.range(1).schema), ["id"])
        query = stream.writeStream.format("parquet").option("path", sink).option("checkpointLocation", state).trigger(availableNow=True).start()
        query.awaitTermination()
        return query

    spark.range(10).coalesce(1).write.parquet(src)
    assert "RocksDB" in run().lastProgress["stateOperators"][0]["customMetrics"].__str__().replace("rocksdb", "RocksDB")
    spark.range(5, 15).coalesce(1).write.mode("append").parquet(src)
    run()  # a new query on the same checkpoint still knows the keys
    assert sorted(r["id"] for r in spark.read.parquet(sink).collect()) == list(range(15))


def test_committed_files_are_those_of_finished_batches(spark):
    src = scratch_dir(spark, "t committed+%20")
    consumer = Consumer.scratch(spark, "t-committed")
    schema = spark.range(1).schema
    assert committed_files(spark, consumer.checkpoint).collect() == []
    for n in range(12):  # beyond the tenth batch the log of files is compacted
        spark.range(n, n + 1).coalesce(1).write.mode("append").parquet(src)
        consumer.run(stream_table(spark, src, schema), lambda b: b)
    assert committed_files(spark, consumer.checkpoint).count() == 12

    def broken(batch):
        if batch.isEmpty():
            return batch
        raise RuntimeError("no")

    spark.range(50, 51).coalesce(1).write.mode("append").parquet(src)
    with pytest.raises(Exception):
        consumer.run(stream_table(spark, src, schema), broken)
    assert consumer.purge() == 12 and consumer.purge() == 0
    # the file of the batch that failed is still there and is loaded next
    assert consumer.run(stream_table(spark, src, schema), lambda b: b) == 1
    assert sorted(r["id"] for r in consumer.result().collect()) == [*range(12), 50]


@pytest.mark.parametrize("live,whole", [("dynamic_table_refresh", "daily_sales_summary"), ("menu_item_performance_live", "menu_item_performance"), ("customer_activity_live", "customer_activity")])
def test_lines_meet_orders_without_state_of_rows(spark, small, tmp_path, monkeypatch, live, whole):
    """No stream joins another, so no row goes into a state store; copies of orders and lines and null keys count as in a batch."""
    for name in "region nation customer supplier part".split():
        spark.read.parquet(f"{small}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    for name, key in (("orders", "o_orderkey"), ("lineitem", "l_orderkey")):
        df = spark.read.parquet(f"{small}/{name}.parquet")
        nulls = df.limit(5).withColumn(key, F.lit(None).cast(df.schema[key].dataType))
        df.union(df.filter(F.col(key) % 5 == 0)).union(nulls).repartition(3).write.parquet(f"{tmp_path}/{name}.parquet")
    streamed, refresh = [], PartialTable.refresh

    def watched(self, stream, partial):
        streamed.append(stream._jdf.queryExecution().logical().toString())
        return refresh(self, stream, partial)

    monkeypatch.setattr(PartialTable, "refresh", watched)
    monkeypatch.setattr(streams, "stream_table", lambda *a, **k: stream_table(*a, **{**k, "max_files": 1}))
    a, b = callables()[live](spark, str(tmp_path)), callables()[whole](spark, str(tmp_path))
    assert a.select(b.columns).exceptAll(b).isEmpty() and a.count() == b.count() > 0
    assert len(streamed) >= 2 and not any("Join" in plan for plan in streamed)
