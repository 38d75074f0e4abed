"""Top-k search and WARC archives against plain versions, and the registered queries against their SQL."""

import base64
import hashlib
import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from larkspur.llm import queries, topk, warc
from tests.compare import compare_one, open_tables


@pytest.mark.parametrize("key", sorted(queries.ORACLE_SQL))
def test_query_against_sql(spark, small, key):
    problem, rows = compare_one(spark, open_tables(small), queries.QUERIES[key], queries.ORACLE_SQL[key], small)
    assert problem is None and rows > 0


def vectors():
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=6) * rng.exponential()]) for i in range(400)]
    same = [0.5] * 6
    rows += [(i, same) for i in range(400, 480)]
    rows += [(500, None), (501, [1.0, None]), (600, [float("nan")] * 6), (700, [float("inf")] + same[1:]), (None, same), (800, [1.0, 2.0]), (900, []), (3, same), (3, same)]
    return rows


def brute(rows, every, k):
    whole = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    asked = {}
    for i, v in whole:
        if i % every == 0:
            asked[i] = min(asked.get(i, v), v)
    out = Counter()
    for q, v in asked.items():
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in whole if i != q)
        out.update((q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k]))
    return out


def test_top_k(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 64)
    monkeypatch.setattr(topk, "STEP", 16)
    monkeypatch.setattr(topk, "QUERIES", 4)
    rows = vectors()
    df = spark.createDataFrame([(i, v, "n", "b") for i, v in rows], "vec_id long, embedding array<double>, norm string, block string")
    got = Counter((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in topk.top_k(df, 20).collect())
    assert got == brute(rows, 20, 10)
    assert topk.top_k(df.limit(0), 20).collect() == []
    few = df.filter("vec_id in (20, 40)")
    assert topk.top_k(few, 20).count() == 2


def test_top_k_beyond_doubles(spark):
    rows = [(0, [3e12, 1.0]), (1, [3e12, 2.0]), (2, [-3e12, 3.0]), (3, [1e5, 1e5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r["score"] for r in topk.top_k(df, 100).collect()}
    top = (1 << 63) - 1
    assert got == {1: top, 2: -top - 1, 3: top}


def pages():
    body = "<p>" + "x" * 300_000 + "</p>"
    return [
        (4, "https://www.example.com/a?b=1", "same"),
        (2, "http://example.org:8080/é x", "same"),
        (9, "https://www.example.com/a?b=1", "same"),
        (1, None, None),
        (3, "", ""),
        (5, "not a url\r\nX: y", body),
        (6, "http://[bad", "é"),
        (7, "https://www.example.com/z", None),
        (8, "https://www.example.com/a?b=1", "other"),
        (8, "https://www.example.com/a?b=1", "other"),
    ]


def test_warc_round_trip(spark):
    df = spark.createDataFrame([(*p, "k", "p") for p in pages()], "page_id long, url string, html string, key string, payload string")
    archive = warc.write(df.repartition(3), block_lines=2)
    out = warc.read(archive, warc.lookup(archive, archive.captures)).collect()
    first = {}
    for i, _, html in pages():
        first[html or ""] = min(first.get(html or "", i), i)
    want = Counter()
    for i, _, html in pages():
        data = (html or "").encode()
        at = first[html or ""]
        sha = base64.b32encode(hashlib.sha1(data).digest()).decode()
        want[i, len(data), sha, "response" if at == i else "revisit", None if at == i else at, data if at == i else None] += 1
    assert Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"], bytes(r["payload"]) if r["payload"] is not None else None) for r in out) == want
    one = warc.lookup(archive, spark.createDataFrame([(warc.url_key("https://www.example.com/a?b=1"),), ("zz,none)/",)], "key string"))
    assert Counter(r["page_id"] for r in one.collect()) == Counter([4, 9, 8, 8])
    large = warc.write(df, at_least=10)
    kinds = warc.read(large, large.captures, with_payload=False).groupBy("record_type").count().collect()
    assert {r["record_type"]: r["count"] for r in kinds} == {"response": len(pages())}
    nothing = warc.write(df.limit(0))
    assert warc.read(nothing, warc.lookup(nothing, nothing.captures)).collect() == []


def test_warc_finds_damage():
    good = warc.record(1, "http://a", b"abc", warc.digest(b"abc"), None, False)
    assert warc.parse(good)[2] == b"abc"
    with pytest.raises(ValueError):
        warc.parse(warc.record(1, "http://a", b"abc", warc.digest(b"abd"), None, False))


def test_url_keys_sort_by_reversed_host():
    assert warc.url_key("https://www.Example.com:80/A?x=1#f") == "com,example,www:80)/A?x=1"
    assert warc.url_key(None) == ")/"


def test_hosts_with_blanks_and_line_separators(spark):
    urls = ["http://exa mple.com/x", "http://exa.com/", "http://mple.com/x", "http://b\u2028ad.com/y", "http://b\x85ad.com/y", "http://b\x1cad.com/", "http://bad.com/", "http://[::1]/z", "http://[exa mple/"]
    df = spark.createDataFrame([(i, u, f"page {i}") for i, u in enumerate(urls)], "page_id long, url string, html string")
    archive = warc.write(df, block_lines=4)
    assert Counter(r["page_id"] for r in warc.lookup(archive, archive.captures).collect()) == Counter(range(len(urls)))
    for i, u in enumerate(urls):
        key = warc.url_key(u)
        assert len(key.split()) == 1 and key.isascii()
        assert [r["page_id"] for r in warc.lookup(archive, spark.createDataFrame([(key,)], "key string")).collect()] == [i]


def test_block_directory_is_sparse(spark):
    df = spark.range(500).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h.example.com/"), F.col("id").cast("string")).alias("url"), F.lit("x").alias("html"))
    archive = warc.write(df, block_lines=100)
    rows = archive.directory.collect()
    assert sum(r["lines"] for r in rows) == 500 and len(rows) < 20
    assert all(r["first_key"] <= r["last_key"] for r in rows)
