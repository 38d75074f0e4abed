"""Tables stored by a partition column, changed by whole partitions.

Only the partitions a change falls into are written again, by Spark's dynamic partition
overwrite; the files of all others keep their names. A partition must follow from the
keys of a row, so that a restated row never leaves its partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.operators.merge import merge_upsert
from larkspur.session import durable, remove_path, scratch_dir
from larkspur.streaming.consume import path_exists


class PartitionedTable:
    """Rows under ``path``, a folder per value of ``by``, which ``of`` derives from the other columns."""

    def __init__(self, spark: SparkSession, path: str, by: str, of: Column):
        self.spark, self.path, self.by, self.of = spark, path, by, of

    @classmethod
    def scratch(cls, spark: SparkSession, label: str, by: str, of: Column) -> "PartitionedTable":
        return cls(spark, scratch_dir(spark, label), by, of)

    def _wide(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.by, self.of)

    def _put(self, wide: DataFrame) -> DataFrame:
        # one file per partition and task: rows of a partition come together first
        dealt = wide.repartition(self.by)
        dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(self.by).parquet(self.path)
        return self.read()

    def write(self, df: DataFrame) -> DataFrame:
        """Replaces the partitions that ``df`` has rows in."""
        return self._put(self._wide(df))

    def read(self, with_partition: bool = False) -> DataFrame:
        rows = self.spark.read.parquet(self.path)
        return rows if with_partition else rows.drop(self.by)

    def merge(self, source: DataFrame, keys: list[str]) -> DataFrame:
        """MERGE of rows by key: partitions without a source row are neither read nor written."""
        fresh = durable(self._wide(source))
        if not path_exists(self.spark, self.path):
            return self._put(fresh)
        # a partition column has few values; as literals they prune the scan of the table
        touched = [r[0] for r in fresh.select(self.by).distinct().collect()]
        stored = self.read(with_partition=True).filter(F.col(self.by).isin(touched))
        # stored before it is written: a table must not be overwritten while it is read
        merged = durable(merge_upsert(stored.select(*fresh.columns), fresh, keys))
        return self._put(merged)

    def retain(self, keep: Column, oldest: Column) -> DataFrame:
        """Deletes the rows that do not ``keep``: partitions below ``oldest`` go as folders, only its own is written again."""
        values = self.read(with_partition=True).select(self.by).distinct()
        marked = values.select(self.by, (F.col(self.by) < oldest).alias("gone"), (F.col(self.by) == oldest).alias("edge")).collect()
        edge = [r[self.by] for r in marked if r["edge"]]
        if edge:
            rows = self.read(with_partition=True).filter(F.col(self.by).isin(edge))
            kept = durable(rows.filter(keep))
            if kept.isEmpty():
                remove_path(self.spark, f"{self.path}/{self.by}={edge[0]}")
            else:
                self._put(kept)
        for row in marked:
            if row["gone"]:
                remove_path(self.spark, f"{self.path}/{self.by}={row[self.by]}")
        return self.read()
