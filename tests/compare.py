"""Compare a Spark result with its SQL check, order-free and type-aware."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def open_tables(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _kind(value) -> str:
    if isinstance(value, bool):
        return "bool"
    if isinstance(value, int):
        return "int"
    if isinstance(value, float):
        return "float"
    return type(value).__name__


def _norm(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, float) and value == 0:
        return 0.0
    return value


def _sort_key(row):
    return tuple((v is not None, _kind(v), v if v is not None else 0) for v in row)


def compare_one(spark, con, fn, sql, folder):
    df = fn(spark, folder)
    cols = sorted(df.columns)
    got = [tuple(_norm(r[c]) for c in cols) for r in df.collect()]
    if sql is None:
        return None, len(got)
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    if sorted(names) != cols:
        return f"columns {cols} vs {sorted(names)}", len(got)
    idx = [names.index(c) for c in cols]
    want = [tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()]
    if len(got) != len(want):
        return f"row count {len(got)} vs {len(want)}", len(got)
    got.sort(key=_sort_key)
    want.sort(key=_sort_key)
    for a, b in zip(got, want):
        for c, x, y in zip(cols, a, b):
            if _kind(x) != _kind(y) or x != y:
                return f"{c}: {x!r} vs {y!r} in {a} / {b}", len(got)
    return None, len(got)
