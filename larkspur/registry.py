"""Named queries and the SQL each one is checked against."""

from __future__ import annotations

import importlib
import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.oracle_views import VIEWS
from larkspur.session import configure

QueryFn = Callable[[SparkSession, str], DataFrame]

PLAN_MODULES = (
    "projections",
    "joins",
    "aggregates",
    "windows",
    "datasets",
    "bi",
    "quality",
    "telemetry",
    "scalar_functions",
    "semi_structured",
    "geography",
    "changes",
    "streams",
    "files",
    "udfs",
    "classifier",
    "prompts",
)


@dataclass(frozen=True)
class Query:
    key: str
    fn: QueryFn
    sql: str | None


_QUERIES: dict[str, Query] = {}


def query(key: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def register(fn: QueryFn) -> QueryFn:
        if key in _QUERIES:
            raise ValueError(f"query {key} is registered twice")
        _QUERIES[key] = Query(key, fn, sql)
        return fn

    return register


def sql_of(key: str) -> str:
    """The SQL of a query that is registered already."""
    return _QUERIES[key].sql


def load_all() -> dict[str, Query]:
    for name in PLAN_MODULES:
        importlib.import_module(f"larkspur.plans.{name}")
    return dict(_QUERIES)


def present(df: DataFrame) -> DataFrame:
    """Plain column types at the boundary: long, double, string, boolean."""
    return df.select([_plain(field).alias(field.name) for field in df.schema.fields])


def _plain(field: T.StructField):
    col = F.col(f"`{field.name}`")
    kind = field.dataType
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
        return col.cast("long")
    if isinstance(kind, (T.DecimalType, T.FloatType)):
        return col.cast("double")
    if isinstance(kind, T.DateType):
        return F.date_format(col, "yyyy-MM-dd")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(col, "yyyy-MM-dd HH:mm:ss")
    if isinstance(kind, T.VariantType):
        return F.to_json(col)
    if isinstance(kind, T.ArrayType):
        return F.array_join(col.cast("array<string>"), ",")
    return col


def callables() -> dict[str, QueryFn]:
    def runner(fn: QueryFn) -> QueryFn:
        return lambda spark, sf_dir: present(fn(configure(spark), sf_dir))

    return {key: runner(q.fn) for key, q in load_all().items()}


def check_sql() -> dict[str, str]:
    return {key: with_views(q.sql) for key, q in load_all().items() if q.sql}


def with_views(sql: str) -> str:
    """Put the domain views a statement names in front of it."""
    needed: set[str] = set()
    pending = [sql]
    while pending:
        text = pending.pop()
        for name in VIEWS:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                pending.append(VIEWS[name])
    body = sql.strip()
    if not needed:
        return body
    heads = ", ".join(f"{name} AS ({VIEWS[name].strip()})" for name in VIEWS if name in needed)
    if body[:5].upper() == "WITH ":
        return f"WITH {heads}, {body[5:]}"
    return f"WITH {heads} {body}"
