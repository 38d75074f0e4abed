"""Tables that follow a query: only the keys a batch touches are computed again."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.session import durable, scratch_dir
from larkspur.streaming.consume import path_exists, run_available

_HERE = "_present"


class RefreshedTable:
    """Keeps ``compute(keys)`` stored per key, a key having any number of rows.

    For results that no partial sums can give; ``PartialTable`` reads nothing but the batch.
    ``touched(batch)`` returns the distinct keys of a micro-batch, null keys too, and
    ``compute(keys)`` recomputes exactly those from the base tables, so late rows change
    closed keys too. A batch writes the rows of its keys, and a marker for each key, to its own
    folder; a reader takes for each key what the latest batch wrote. So writes grow with
    the change, a replayed batch leaves one copy, a key without rows is gone, and a new
    object on the same paths goes on where the last one stopped.
    """

    def __init__(self, spark: SparkSession, keys: list[str], touched: Callable[[DataFrame], DataFrame], compute: Callable[[DataFrame], DataFrame], path: str, checkpoint: str):
        self.spark, self.keys, self.touched, self.compute = spark, keys, touched, compute
        self.path, self.checkpoint = path, checkpoint
        self.refreshes = 0

    @classmethod
    def scratch(cls, spark, keys, touched, compute, label: str) -> "RefreshedTable":
        return cls(spark, keys, touched, compute, scratch_dir(spark, label), scratch_dir(spark, f"{label}-state"))

    def refresh(self, stream: DataFrame) -> int:
        """Process what is pending; returns the number of batches this run made."""
        before = self.refreshes
        run_available(stream, self.checkpoint, self._on_batch)
        return self.refreshes - before

    def _on_batch(self, batch: DataFrame, batch_id: int) -> None:
        keys = durable(self.touched(batch).select(*self.keys))
        new = self.compute(keys).withColumn(_HERE, F.lit(True))
        marks = keys.withColumn(_HERE, F.lit(False))
        new.unionByName(marks, allowMissingColumns=True).write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")
        self.refreshes += 1

    def read(self) -> DataFrame:
        if not path_exists(self.spark, self.path):
            raise RuntimeError("nothing has been refreshed yet")
        rows = self.spark.read.option("basePath", self.path).parquet(self.path)
        names = {k: f"_l_{k}" for k in [*self.keys, "batch_id"]}
        latest = rows.filter(~F.col(_HERE)).groupBy(*self.keys).agg(F.max("batch_id").alias("batch_id")).withColumnsRenamed(names)
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()])
        return rows.filter(_HERE).join(latest, same).drop("batch_id", _HERE, *names.values())
