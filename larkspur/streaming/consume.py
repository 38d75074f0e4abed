"""Consume-once jobs on Structured Streaming.

Each consumer owns a checkpoint, so several consumers of one source never take rows
from each other. ``availableNow`` processes what is pending and stops: with nothing
pending the batch function is not called, which is the run-only-if-data guard.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.session import remove_path, scratch_dir

BatchFn = Callable[[DataFrame], DataFrame]


def stream_table(spark: SparkSession, folder: str, schema: T.StructType, pattern: str | None = None, fmt: str = "parquet", max_files: int | None = None, **options) -> DataFrame:
    """Files of a folder as an unbounded table; every file is read once per checkpoint."""
    reader = spark.readStream.schema(schema).format(fmt).options(**options)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(folder)


def path_exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(where)


def is_folder(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).getFileStatus(where).isDirectory()


def committed_files(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(path) of every file a checkpoint has read in a batch that was committed.

    Commits name the batches that are done, the offsets of the last of them say how far the log of
    source files counts. Files that arrived later, or stand in a batch that never finished, are not in it.
    """
    none = spark.createDataFrame([], "path string")
    if not path_exists(spark, f"{checkpoint}/commits"):
        return none
    commits = spark.read.format("binaryFile").load(f"{checkpoint}/commits")
    last = commits.agg(F.max(F.element_at(F.split("path", "/"), -1).try_cast("long"))).first()[0]
    if last is None:
        return none
    offsets = spark.read.text(f"{checkpoint}/offsets/{last}").select(F.get_json_object("value", "$.logOffset").cast("long").alias("offset"))
    reach = offsets.agg(F.max("offset")).first()[0]
    entries = spark.read.text(f"{checkpoint}/sources/0").select(F.from_json("value", "path string, batchId long").alias("e"))
    # the log escapes its paths as URIs do
    path = F.url_decode(F.replace("e.path", F.lit("+"), F.lit("%2B")))
    return entries.filter((F.col("e.path").isNotNull()) & (F.col("e.batchId") <= reach)).select(path.alias("path")).distinct()


def run_available(stream: DataFrame, checkpoint: str, on_batch: Callable[[DataFrame, int], None]) -> None:
    query = (
        stream.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


@dataclass
class Consumer:
    """Transforms pending rows and appends the result exactly once.

    A batch writes to its own folder and overwrites it, so a batch that is replayed
    after a failure leaves one copy. Sink and checkpoint are all the state there is: a
    new object on the same paths goes on where the last one stopped. ``batches`` are
    those of this object.
    """

    spark: SparkSession
    sink: str
    checkpoint: str
    schema: T.StructType | None = None
    batches: list[int] = field(default_factory=list)

    @classmethod
    def scratch(cls, spark: SparkSession, label: str) -> "Consumer":
        return cls(spark, scratch_dir(spark, label), scratch_dir(spark, f"{label}-state"))

    def run(self, stream: DataFrame, transform: BatchFn) -> int:
        """Process what is pending; returns the number of batches this run made."""
        before = len(self.batches)
        self.schema = transform(self.spark.createDataFrame([], stream.schema)).schema

        def write(batch: DataFrame, batch_id: int) -> None:
            transform(batch).write.mode("overwrite").parquet(f"{self.sink}/batch_id={batch_id}")
            self.batches.append(batch_id)

        run_available(stream, self.checkpoint, write)
        return len(self.batches) - before

    def purge(self) -> int:
        """Deletes the source files whose rows are in committed batches, and no others; returns how many there were."""
        gone = 0
        for row in committed_files(self.spark, self.checkpoint).toLocalIterator():
            if path_exists(self.spark, row["path"]):
                remove_path(self.spark, row["path"])
                gone += 1
        return gone

    def result(self) -> DataFrame:
        """All rows consumed so far, by this object or an earlier one."""
        if not path_exists(self.spark, self.sink):
            if self.schema is None:
                raise RuntimeError("nothing has been consumed yet")
            return self.spark.createDataFrame([], self.schema).withColumn("batch_id", F.lit(None).cast("int"))
        reader = self.spark.read.option("basePath", self.sink)
        if self.schema is not None:
            reader = reader.schema(T.StructType([*self.schema.fields, T.StructField("batch_id", T.IntegerType())]))
        return reader.parquet(self.sink)


def append_stream(stream: DataFrame, label: str) -> DataFrame:
    """Run an append-mode stream, such as deduplicated rows, into files and read them back."""
    spark = stream.sparkSession
    sink, state = scratch_dir(spark, label), scratch_dir(spark, f"{label}-state")
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", sink)
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(sink)


def daily_parts(batch: DataFrame, ts: str, value: str) -> DataFrame:
    """Totals per day of the rows of one batch; ``daily_totals`` adds the batches up.

    Sums of parts need no watermark, so a row counts however late or in whatever file it comes.
    """
    return batch.groupBy(F.date_trunc("day", F.col(ts).cast("timestamp")).alias("day")).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))


def daily_totals(parts: DataFrame) -> DataFrame:
    return parts.groupBy("day").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


def lookback_parts(batch: DataFrame, ts: str, width: str, every: str) -> DataFrame:
    """Counts of one batch over sliding windows: 'the last hour, looked at every quarter'."""
    w = F.window(F.col(ts).cast("timestamp"), width, every)
    return batch.groupBy(w.alias("w")).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n")


def lookback_totals(parts: DataFrame) -> DataFrame:
    return parts.groupBy("window_start", "window_end").agg(F.sum("n").alias("n"))


def once(stream: DataFrame, keys: list[str]) -> DataFrame:
    """Drops redeliveries for good: the keys seen are kept in the checkpoint, however old."""
    return stream.dropDuplicates(keys)
