"""Whitening against exact sums and a library eigensolver, and the solver on awkward spectra."""

import math
from collections import Counter

import numpy as np
import pytest

from larkspur.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<double>, component string, n string, x string"


def brute(rows, components=4):
    """{(vec_id, component): [(n, deviation, |whitened|, explained)]}"""
    whole = [(i, [math.floor(256 * c) for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    widths = Counter(len(x) for _, x in whole)
    width = min(widths, key=lambda w: (-widths[w], w))
    whole = [(i, x) for i, x in whole if len(x) == width]
    each = sorted({tuple(x) for _, x in whole})
    n, sums = len(each), [sum(c) for c in zip(*each)]
    y = np.array([[n * c - s for c, s in zip(x, sums)] for x in each], dtype=float) / n
    e, v = np.linalg.eigh(y.T @ y / n)
    e, v = e[::-1], v[:, ::-1]
    out = {}
    for i, x in whole:
        dev = sum((n * c - s) ** 2 for c, s in zip(x, sums))
        at = np.array([n * c - s for c, s in zip(x, sums)], dtype=float) / n
        for k in range(min(components, width)):
            if e[k] > 1e-13 * e.sum():
                out.setdefault((i, k + 1), []).append((n, dev, abs(float(at @ v[:, k]) / math.sqrt(e[k])), e[k] / e.sum()))
    return out


def rows_of():
    rng = np.random.default_rng(8)
    spread = np.exp(rng.normal(size=6))
    rows = [(i, [float(c) for c in rng.normal(size=6) * spread]) for i in range(300)]
    rows += [(i, [0.25] * 6) for i in range(300, 380)]  # copies count once in the fit
    rows += [(3, rows[3][1]), (3, rows[3][1]), (None, rows[4][1]), (None, [1.0, 2.0, 3.0, 4.0, 5.0, -0.0])]
    rows += [(900, None), (901, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (902, [float("nan")] * 6), (903, [float("inf")] * 6), (904, [1.0, 2.0]), (905, []), (906, [1e300] + [0.0] * 5)]
    return rows


def test_whiten(spark):
    rows = rows_of()
    df = spark.createDataFrame([(i, v, "c", "n", "x") for i, v in rows], SCHEMA).repartition(5)
    got: dict = {}
    signs: dict = {}
    for r in whitening.whiten(df).collect():
        got.setdefault((r["vec_id"], r["component"]), []).append((r["n"], r["deviation"], r["whitened"], r["explained"]))
        signs.setdefault(r["component"], []).append(r["whitened"])
        assert r["identity_error"] < 1e-9
    want = brute([r for r in rows if r[0] != 906])
    assert set(got) == set(want)
    for key, found in got.items():
        found, expected = sorted((n, d, abs(w), e) for n, d, w, e in found), sorted(want[key])
        assert [f[:2] for f in found] == [x[:2] for x in expected]
        assert np.allclose([f[2:] for f in found], [x[2:] for x in expected], rtol=1e-9, atol=1e-9)
    # one sign for all rows: a component is centred over the distinct vectors
    assert all(min(v) < 0 < max(v) for v in signs.values())


def test_whiten_degenerate(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert whitening.whiten(none).collect() == []
    same = spark.createDataFrame([(i, [1.0, 2.0], "", "", "") for i in range(3)], SCHEMA)
    assert whitening.whiten(same).collect() == []
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 1.0], "", "", "") for i in range(8)], SCHEMA)
    found = whitening.whiten(line).collect()
    assert {r["component"] for r in found} == {1} and all(abs(r["explained"] - 1) < 1e-12 for r in found)


def test_deviation_beyond_64_bits(spark):
    rows = [(i, [float(i) * 1e12, 1.0], "", "", "") for i in range(4)]
    assert {r["deviation"] for r in whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()} == {None}


@pytest.mark.parametrize("width", [1, 2, 3, 17, 64])
@pytest.mark.parametrize("kind", ["wishart", "two values", "one value", "falling", "zero", "whole"])
def test_eigen(width, kind):
    rng = np.random.default_rng(width)
    q = np.linalg.qr(rng.normal(size=(width, width)))[0]
    half = width // 2
    spectrum = {
        "wishart": None,
        "two values": np.r_[np.ones(half), np.full(width - half, 2.0)],
        "one value": np.ones(width),
        "falling": 0.5 ** np.arange(width),
        "zero": np.zeros(width),
        "whole": np.arange(width) - float(half),
    }[kind]
    g = rng.normal(size=(width, width))
    m = g @ g.T if spectrum is None else (q * spectrum) @ q.T
    e, v = whitening.eigen(m)
    size = max(np.abs(e).max(), 1e-30)
    assert np.abs(e - np.linalg.eigvalsh(m)[::-1]).max() <= 1e-12 * size
    assert np.abs(v.T @ v - np.eye(width)).max() < 1e-12
    assert np.abs(m @ v - v * e).max() <= 1e-12 * size


def test_polar_factor():
    rng = np.random.default_rng(2)
    a = rng.normal(size=(20, 20))
    a = a + a.T
    e, v = np.linalg.eigh(a)
    assert np.abs(whitening.polar(a) - (v * np.sign(e)) @ v.T).max() < 1e-12


def test_query(spark, small):
    out = queries.QUERIES["op13_whitening"](spark, small)
    rows = [(r["vec_id"], [float(c) for c in r["embedding"]]) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    want = brute(rows)
    found = out.collect()
    assert len(found) == sum(map(len, want.values())) > 0
    for r in found:
        n, dev, w, e = want[r["vec_id"], r["component"]][0]
        assert (r["n"], r["deviation"]) == (n, dev) and abs(abs(r["whitened"]) - w) < 1e-9 and abs(r["explained"] - e) < 1e-12
