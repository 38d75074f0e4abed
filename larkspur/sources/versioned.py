"""Tables on immutable files that can be rewritten while they are read.

Parquet has no UPDATE or MERGE. A rewrite puts new files beside the old ones and then
publishes the names of the live files under the next version number, in one append of one
file; readers follow the highest number, so they never see a half-written state, and a
rewrite that broke before it was published is simply done again. Two writers of one table
must take turns.
"""

from __future__ import annotations

from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.session import scratch_dir
from larkspur.sources.files import list_files, literal_path
from larkspur.streaming.consume import path_exists

FILE = "_file"


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    @classmethod
    def scratch(cls, spark: SparkSession, label: str) -> "VersionedTable":
        return cls(spark, scratch_dir(spark, label))

    def _published(self) -> DataFrame:
        if not path_exists(self.spark, f"{self.path}/live"):
            return self.spark.createDataFrame([], "version int, file string")
        return self.spark.read.schema("version int, file string").parquet(f"{self.path}/live")

    def version(self) -> int:
        return self._published().agg(F.max("version")).first()[0] or 0

    def files(self, version: int | None = None) -> list[str]:
        """The live files of a version; names only, never contents."""
        wanted = version or self.version()
        return [r["file"] for r in self._published().filter(F.col("version") == wanted).select("file").toLocalIterator()]

    def read(self, version: int | None = None) -> DataFrame:
        return self._open(self.files(version))

    def _open(self, files: list[str]) -> DataFrame:
        return self.spark.read.parquet(*[literal_path(unquote(f)) for f in files])

    def write(self, df: DataFrame) -> DataFrame:
        """Store the whole table anew as the next version and return it as read from storage."""
        return self._store(df, [])

    def rewrite(self, matches: Column, change: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """Applies ``change`` to the rows of the files that hold a matching row; all other files stay as they are."""
        live = self.files()
        hit = self._open(live).filter(matches).select(F.col("_metadata.file_path").alias(FILE)).distinct()
        touched = {r[FILE] for r in hit.toLocalIterator()}
        if not touched:
            return self.read()
        return self._store(change(self._open(sorted(touched))), [f for f in live if f not in touched])

    def _store(self, df: DataFrame, kept: list[str]) -> DataFrame:
        version = self.version() + 1
        folder = f"{self.path}/data/v{version:08d}"
        df.write.mode("overwrite").parquet(folder)
        new = list_files(self.spark, folder, with_md5=False, pattern="*.parquet").select(F.col("file_path").alias("file"))
        old = self.spark.createDataFrame([(f,) for f in kept], "file string")
        listing = new.unionByName(old).select(F.lit(version).alias("version"), "file")
        listing.coalesce(1).write.mode("append").parquet(f"{self.path}/live")
        return self.read(version)
