"""Ranked lexical search against a plain version: every split into short and long lists, shards, windows and blocks."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from larkspur.llm import lexical
from tests.compare import compare_one, open_tables
from tests.llm import corpus as C

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute(docs, items, k=50):
    held = [(i, TERM.findall(C.ascii_lower(t or ""))) for i, t in docs]
    held = [(i, w) for i, w in held if w]
    n_docs, n_terms = len(held), sum(len(w) for _, w in held)
    df = Counter(t for _, w in held for t in set(w))
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * f + 1))) for t, f in df.items()}
    asked: dict = {}
    for item, text in items:
        asked.setdefault(item, set()).update(TERM.findall(C.ascii_lower(text or "")))
    out = Counter()
    for item, terms in asked.items():
        scored = []
        for i, w in held:
            m = 100 - 50 + 50 * len(w) * n_docs // n_terms
            tf = Counter(w)
            score = sum(weight[t] * (1_000_000_000 * tf[t] // (1000 * tf[t] + 20 * m)) for t in terms if t in tf)
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out.update((item, n + 1, None if none else i, -s) for n, (s, none, i) in enumerate(sorted(scored)[:k]))
    return out


def plain(df):
    return Counter((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect())


@pytest.mark.parametrize("short", [0.0, 0.3, 50.0])
@pytest.mark.parametrize("k", [3, 50])
def test_awkward_corpus(spark, short, k):
    pairs = [(r[0], r[1]) for r in C.documents()]
    docs = spark.createDataFrame(C.documents(), C.DOCS).repartition(3)
    items = spark.createDataFrame([(i, t, "r", "s") for i, t in [*C.benchmark(), (None, "aa yy bb")]], "item_id long, text string, rank string, score string")
    want = brute(pairs, [*C.benchmark(), (None, "aa yy bb")], k)
    assert plain(lexical.search(docs, items, k, shard_bytes=2000, window=3, short=short)) == want
    assert any(i is None for i, *_ in want)


def crowd(seed):
    """Few words of steep frequencies, many equal texts and so many ties; ids fall while rows rise."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    texts = [" ".join(rng.choices(words, weights, k=rng.randint(1, 40))) for _ in range(150)]
    docs = [(1000 - n, rng.choice(texts)) for n in range(700)] + [(n, texts[0]) for n in range(1001, 1300)]
    items = [(n, " ".join(rng.choices(words, k=rng.randint(1, 12)))) for n in range(40)]
    return docs, items


@pytest.mark.parametrize("blocks", [1, 4])
def test_ties_and_blocks(spark, blocks):
    docs, items = crowd(blocks)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    asked = spark.createDataFrame(items, "item_id long, text string")
    got = lexical.search(df, asked, 10, block_items=40 // blocks, shard_bytes=1500, window=16)
    assert plain(got) == brute(docs, items, 10)


def test_pruning_skips_and_keeps_results():
    """With a threshold from one shard, a second one gives candidates from essential lists only, and the same top."""
    rng = np.random.default_rng(5)
    n = 5000
    lists = {t: np.sort(rng.choice(n, size, replace=False)) for t, size in enumerate([20, 300, 2000, 4500])}
    row = {
        "ids": list(range(n)),
        "lengths": rng.integers(5, 200, n).astype(np.int64).tobytes(),
        "terms": list(lists),
        "counts": [len(v) for v in lists.values()],
        "places": np.concatenate(list(lists.values())).astype("<u4").tobytes(),
        "times": rng.integers(1, 5, sum(map(len, lists.values()))).astype("<u4").tobytes(),
    }
    shard = lexical.Postings(row, n, 500_000)
    weight = {0: 5000, 1: 2500, 2: 900, 3: 60}
    total = np.zeros(n, np.int64)
    for t, (place, part) in shard.lists.items():
        total[place] += weight[t] * part
    order = np.lexsort((np.arange(n), -total))[:10]
    for short in (0.0, 0.1):
        at, score = shard.top(list(lists), weight, 10, 0, 256, short)
        assert at.tolist() == order.tolist() and score.tolist() == total[order].tolist()
    high = int(total[order[4]])
    at, score = shard.top(list(lists), weight, 10, high - 1, 256, 0.1)
    assert at.tolist() == [p for p in order.tolist() if total[p] >= high]


def test_empty(spark):
    docs = spark.createDataFrame(C.documents(), C.DOCS)
    none = spark.createDataFrame([], "item_id long, text string")
    items = spark.createDataFrame(C.benchmark(), "item_id long, text string")
    assert lexical.search(docs, none).collect() == []
    assert lexical.search(docs.limit(0), items).collect() == []
    assert lexical.search(docs.filter("doc_id in (2, 3, 4)"), items).collect() == []
    assert lexical.search(docs, spark.createDataFrame([(1, "!!"), (2, None)], "item_id long, text string")).collect() == []


def test_long_texts_are_read_in_parts(monkeypatch):
    monkeypatch.setattr(lexical, "_PIECE", 10)
    for text in (b"", b"a", b"ab cd ef gh ij kl mn", b"x" * 50, b"ab " + b"y" * 30 + b" cd ", b" " * 40):
        parts = list(lexical._pieces(text))
        assert [w for p in parts for w in p.split()] == text.split() and b"".join(parts) == text


def test_query_against_sql(spark, small):
    problem, rows = compare_one(spark, open_tables(small), lexical.query, lexical.ORACLE_SQL, small)
    assert problem is None and rows > 40 * 40
