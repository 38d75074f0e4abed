"""Loads that remember what they have loaded.

The log is an append-only table keyed by file, checksum and run. The loader consults it: a
file whose content is logged is not loaded again unless the load is forced, a file that was
replaced is. Rows of a run go to a folder of their own before the run is logged, so a load
that broke in between starts over under the same number and leaves one copy. One loader
writes a log at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.session import durable, scratch_dir
from larkspur.sources import files as S
from larkspur.streaming.consume import path_exists

ENTRY = T.StructType(
    [
        T.StructField("file_path", T.StringType()),
        T.StructField("md5", T.StringType()),
        T.StructField("size", T.LongType()),
        T.StructField("last_modified", T.TimestampType()),
        T.StructField("rows_parsed", T.LongType()),
        T.StructField("rows_loaded", T.LongType()),
        T.StructField("errors_seen", T.LongType()),
        T.StructField("first_error", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("loaded_at", T.TimestampType()),
    ]
)


@dataclass
class LoggedTable:
    """A table fed from staged files, and the log of its loads."""

    spark: SparkSession
    path: str
    log: str
    schema: T.StructType

    @classmethod
    def scratch(cls, spark: SparkSession, label: str, schema: T.StructType) -> "LoggedTable":
        return cls(spark, scratch_dir(spark, label), scratch_dir(spark, f"{label}-log"), schema)

    def history(self) -> DataFrame:
        """One row per run and file, and its run; none before the first load."""
        return self._runs(self.log, ENTRY)

    def rows(self) -> DataFrame:
        """All loaded rows with the run that loaded them."""
        return self._runs(self.path, self.schema)

    def _runs(self, path: str, schema: T.StructType) -> DataFrame:
        wide = T.StructType([*schema.fields, T.StructField("run", T.IntegerType())])
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], wide)
        return self.spark.read.option("basePath", path).schema(wide).parquet(path)

    def load(self, folder: str, force: bool = False, pattern: str | None = None, **options) -> int | None:
        """Loads the files of a folder that the log does not know, or all if forced; the run, None if there was no file."""
        found = S.list_files(self.spark, folder, pattern=pattern).select("file_path", "path", "md5", "size", "last_modified")
        if not force:
            known = self.history().filter("status <> 'LOAD_FAILED'").select("file_path", "md5").distinct()
            found = found.join(known, ["file_path", "md5"], "left_anti")
        found = durable(found)
        paths = [S.literal_path(r["path"]) for r in found.select("path").toLocalIterator()]
        if not paths:
            return None
        run = (self.history().agg(F.max("run")).first()[0] or 0) + 1
        rows = S.load_tolerant(self.spark, paths, self.schema, **options)
        S.on_error(rows, "CONTINUE").select(*self.schema.names).write.mode("overwrite").parquet(f"{self.path}/run={run}")
        entries = found.drop("path").join(S.load_report(rows), "file_path", "left").withColumns(
            {
                "rows_parsed": F.coalesce("rows_parsed", F.lit(0)),
                "rows_loaded": F.coalesce("rows_loaded", F.lit(0)),
                "errors_seen": F.coalesce("errors_seen", F.lit(0)),
                "status": F.coalesce("status", F.lit("LOADED")),
                "loaded_at": F.current_timestamp(),
            }
        )
        entries.select(*ENTRY.names).write.mode("overwrite").parquet(f"{self.log}/run={run}")
        return run
