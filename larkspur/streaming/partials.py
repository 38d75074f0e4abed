"""Aggregates that follow a stream from its batches alone.

A batch is reduced to partial rows that can be added up, at the finest grain an exact result
needs: for a distinct count that is one row per counted value with its multiplicity, so that a
value is gone when all that brought it have been taken back. Nothing but the batch is read.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.session import remove_path, scratch_dir
from larkspur.streaming.consume import path_exists, run_available


class PartialTable:
    """Partial rows per batch: ``adds`` are summed and ``most`` maximised per ``keys``; ``count`` is the one of ``adds`` that counts rows.

    A batch overwrites its own folder, so a replay leaves one copy, and a new object on the same
    paths goes on where the last one stopped. When more than ``bound`` batches have piled up they are
    folded into one base, which is published before the batches go. Retractions are rows with
    negated sums; a key whose rows have all been taken back is gone. Null keys are keys. Maxima
    cannot be taken back: they hold for streams that only grow.
    """

    def __init__(self, spark: SparkSession, keys: Sequence[str], adds: Sequence[str], path: str, checkpoint: str, most: Sequence[str] = (), count: str = "n", bound: int = 32):
        self.spark, self.keys, self.adds, self.most, self.count = spark, list(keys), list(adds), list(most), count
        self.path, self.checkpoint, self.bound = path, checkpoint, bound
        self.batches = 0

    @classmethod
    def scratch(cls, spark: SparkSession, label: str, keys: Sequence[str], adds: Sequence[str], most: Sequence[str] = (), bound: int = 32) -> "PartialTable":
        return cls(spark, keys, adds, scratch_dir(spark, label), scratch_dir(spark, f"{label}-state"), most, bound=bound)

    def fold(self, rows: DataFrame) -> DataFrame:
        """Adds partial rows up; types stay, so that folds of folds look like folds."""
        sums = [F.sum(c).cast(rows.schema[c].dataType).alias(c) for c in self.adds]
        return rows.groupBy(*self.keys).agg(*sums, *[F.max(c).alias(c) for c in self.most])

    def refresh(self, stream: DataFrame, partial: Callable[[DataFrame], DataFrame]) -> int:
        """Takes in what is pending; ``partial`` turns a batch into rows of the keys and measures. Returns the batches of this run."""
        before = self.batches

        def on_batch(batch: DataFrame, batch_id: int) -> None:
            self.fold(partial(batch)).write.mode("overwrite").parquet(f"{self.path}/parts/batch_id={batch_id}")
            self.batches += 1

        run_available(stream, self.checkpoint, on_batch)
        self._compact()
        return self.batches - before

    def read(self) -> DataFrame:
        """One row per key that still has rows."""
        folders = self._live_folders()
        if not folders:
            raise RuntimeError("nothing has been taken in yet")
        # a folder holds a key once
        rows = self._stored()
        return (rows if len(folders) == 1 else self.fold(rows)).filter(F.col(self.count) != 0)

    def _folders(self, kind: str, name: str) -> list[int]:
        """Numbers of the complete folders of a kind; a folder that is being written has no mark yet."""
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}/{name}=*/_SUCCESS")
        found = where.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).globStatus(where)
        return sorted(int(f.getPath().getParent().getName().split("=")[1]) for f in found or [])

    def _live(self) -> tuple[int | None, list[int]]:
        base = max(self._folders("base", "upto"), default=None)
        return base, [b for b in self._folders("parts", "batch_id") if base is None or b > base]

    def _live_folders(self) -> list[str]:
        base, batches = self._live()
        folders = [f"{self.path}/parts/batch_id={b}" for b in batches]
        return folders if base is None else [*folders, f"{self.path}/base/upto={base}"]

    def _stored(self) -> DataFrame:
        return self.spark.read.parquet(*self._live_folders())

    def _compact(self) -> None:
        base, batches = self._live()
        if len(batches) <= self.bound:
            return
        self.fold(self._stored()).filter(F.col(self.count) != 0).write.mode("overwrite").parquet(f"{self.path}/base/upto={batches[-1]}")
        for b in batches:
            remove_path(self.spark, f"{self.path}/parts/batch_id={b}")
        if base is not None:
            remove_path(self.spark, f"{self.path}/base/upto={base}")
