"""Change logs: difference of two states, net effect, state as of a time.

A log row has ``key, action (INSERT/DELETE), is_update, commit_ts, commit_id, step``
and payload columns; an update is a DELETE and an INSERT at one commit. Every result
is an aggregate per key with a map-side combine, so a key with a third of all changes
still reaches its reducer as one row per task.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PLACE = ("commit_ts", "commit_id", "step")


def _at(ts: datetime) -> Column:
    return F.lit(ts).cast("timestamp_ntz")


def diff_states(old: DataFrame, new: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Change rows that turn ``old`` into ``new``; keys are unique within a state.

    Both states are stacked and grouped by key instead of full-outer joined: the
    grouping combines early and has no skewed side.
    """
    body = F.struct(*values)
    both = old.select(*keys, F.lit(0).alias("_side"), body.alias("_row")).unionByName(
        new.select(*keys, F.lit(1).alias("_side"), body.alias("_row"))
    )
    per_key = both.groupBy(*keys).agg(
        F.max(F.when(F.col("_side") == 0, F.col("_row"))).alias("_old"),
        F.max(F.when(F.col("_side") == 1, F.col("_row"))).alias("_new"),
        F.count_if(F.col("_side") == 0).alias("_had"),
        F.count_if(F.col("_side") == 1).alias("_has"),
    )

    def change(action: str, update: bool, row: str) -> Column:
        return F.struct(F.lit(action).alias("action"), F.lit(update).alias("is_update"), F.col(row).alias("row"))

    rows = (
        F.when(F.col("_had") == 0, F.array(change("INSERT", False, "_new")))
        .when(F.col("_has") == 0, F.array(change("DELETE", False, "_old")))
        .when(
            ~F.col("_old").eqNullSafe(F.col("_new")),
            F.array(change("DELETE", True, "_old"), change("INSERT", True, "_new")),
        )
    )
    row_id = F.sha2(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]), 256)
    return per_key.select(*keys, F.explode(rows).alias("_c")).select(
        *keys, "_c.action", "_c.is_update", row_id.alias("row_id"), *[F.col(f"_c.row.{v}").alias(v) for v in values]
    )


def net_changes(log: DataFrame, key: str, values: list[str]) -> DataFrame:
    """Net effect of a stretch of the log.

    A key whose first change is a DELETE existed before; one whose last change is an
    INSERT exists after. Insert-then-delete leaves nothing.
    """
    place = F.struct(*PLACE)
    body = F.struct(*values)
    ends = log.groupBy(key).agg(
        F.min_by("action", place).alias("_first"),
        F.max_by("action", place).alias("_last"),
        F.min_by(body, place).alias("_old"),
        F.max_by(body, place).alias("_new"),
    )
    existed, exists = F.col("_first") == "DELETE", F.col("_last") == "INSERT"
    rows = F.when(
        existed & exists,
        F.array(
            F.struct(F.lit("DELETE").alias("action"), F.lit(True).alias("is_update"), F.col("_old").alias("row")),
            F.struct(F.lit("INSERT").alias("action"), F.lit(True).alias("is_update"), F.col("_new").alias("row")),
        ),
    ).when(
        existed,
        F.array(F.struct(F.lit("DELETE").alias("action"), F.lit(False).alias("is_update"), F.col("_old").alias("row"))),
    ).when(
        exists,
        F.array(F.struct(F.lit("INSERT").alias("action"), F.lit(False).alias("is_update"), F.col("_new").alias("row"))),
    )
    return ends.select(key, F.explode(rows).alias("_c")).select(
        key, "_c.action", "_c.is_update", *[F.col(f"_c.row.{v}").alias(v) for v in values]
    )


def append_only(log: DataFrame) -> DataFrame:
    return log.filter((F.col("action") == "INSERT") & ~F.col("is_update"))


def snapshot_as_of(log: DataFrame, key: str, values: list[str], ts: datetime) -> DataFrame:
    """State after all changes up to and including ``ts``."""
    last = (
        log.filter(F.col("commit_ts") <= _at(ts))
        .groupBy(key)
        .agg(F.max_by(F.struct("action", *values), F.struct(*PLACE)).alias("_last"))
    )
    return last.filter(F.col("_last.action") == "INSERT").select(key, *[F.col(f"_last.{v}").alias(v) for v in values])


def changed_rows(before: DataFrame, after: DataFrame, key: str, value: str) -> DataFrame:
    """Rows whose value differs between two states (null-safe), with both values."""
    b = before.select(key, F.col(value).alias("restored_value"))
    a = after.select(key, F.col(value).alias("bad_value"))
    return a.join(b, key).filter(~F.col("bad_value").eqNullSafe(F.col("restored_value")))
