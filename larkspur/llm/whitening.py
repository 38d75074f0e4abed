"""Whitening of embeddings along spectral components found by QDWH divide and conquer.

Spark adds up what the covariance needs over the distinct vectors: their number and sums,
then the products of the centred vectors. What reaches the driver is one matrix of the
width of a vector. Its eigenvectors come from the polar factor of the shifted matrix: the
factor's sign splits the space into two invariant subspaces, and each half is split again
until every subspace is one component. The components, at most a few vectors, travel back
to the rows, which are projected where they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import table
from larkspur.session import durable

SCALE = 256
COMPONENTS = 4

_EPS = np.finfo(np.float64).eps
_LARGEST = (1 << 63) - 1
#: whole doubles are exact below this size
_EXACT = float(1 << 53)
#: a component whose share of the trace is smaller has no variance beyond rounding
_NO_VARIANCE = 1e-13


def polar(a: np.ndarray, rounds: int = 40) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix by dynamically weighted Halley steps."""
    width = len(a)
    x = a / max(np.linalg.norm(a), np.finfo(np.float64).tiny)
    low = _EPS  # a lower bound of the singular values that matter, driven to 1
    for _ in range(rounds):
        square = low * low
        d = np.cbrt(4.0 * (1.0 - square) / (square * square))
        step = np.sqrt(1.0 + d)
        wa = step + 0.5 * np.sqrt(max(8.0 - 4.0 * d + 8.0 * (2.0 - square) / (square * step), 0.0))
        wb = 0.25 * (wa - 1.0) ** 2
        wc = wa + wb - 1.0
        if wc > 100.0:  # far from orthogonal: the form by QR is stable, that by Cholesky is not
            q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, np.eye(width)]))
            new = (wb / wc) * x + (wa - wb / wc) / np.sqrt(wc) * (q[:width] @ q[width:].T)
        else:
            new = (wb / wc) * x + (wa - wb / wc) * np.linalg.solve(np.eye(width) + wc * (x.T @ x), x.T).T
        new = 0.5 * (new + new.T)
        low = min(low * (wa + wb * square) / (1.0 + wc * square), 1.0)
        moved = np.linalg.norm(new - x)
        x = new
        if moved < 10 * _EPS * width and 1.0 - low < 10 * _EPS:
            break
    return x


def _basis(projector: np.ndarray, rank: int, rng: np.random.Generator) -> np.ndarray:
    """An orthonormal basis of the range of a projector, from random directions projected twice."""
    q, _ = np.linalg.qr(projector @ rng.standard_normal((len(projector), rank)))
    return np.linalg.qr(projector @ q)[0]


def _split(a: np.ndarray, size: float, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray] | None:
    """Bases of the invariant subspaces above and below a shift; None for a multiple of the identity."""
    width = len(a)
    middle = np.trace(a) / width
    if np.linalg.norm(a - middle * np.eye(width)) <= 4 * _EPS * width * size:
        return None
    diagonal = np.sort(np.diag(a))
    # Rayleigh quotients lie between the extreme eigenvalues, so a shift between two of them
    # leaves something on either side; a shift that hits an eigenvalue gives no projector
    shifts = [np.median(diagonal), middle, *(middle + f * (diagonal[-1] - diagonal[0]) for f in (0.1, -0.1, 0.23, -0.23, 0.37, -0.37))]
    best = None
    for shift in shifts:
        u = polar(a - shift * np.eye(width))
        up = int(np.rint(0.5 * (np.trace(u) + width)))
        if not 0 < up < width:
            continue
        above = _basis(0.5 * (np.eye(width) + u), up, rng)
        below = 0.5 * (np.eye(width) - u)
        below = below - above @ (above.T @ below)
        below = _basis(below, width - up, rng)
        whole = np.linalg.qr(np.hstack([above, below]))[0]
        above, below = whole[:, :up], whole[:, up:]
        left = np.linalg.norm(above.T @ a @ below)
        if best is None or left < best[0]:
            best = (left, above, below)
        if left <= 50 * _EPS * width * size:
            break
    return None if best is None else best[1:]


def _rotate(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenpairs of a two by two block in closed form."""
    half, cross = 0.5 * (a[0, 0] - a[1, 1]), 0.5 * (a[0, 1] + a[1, 0])
    angle = 0.5 * np.arctan2(cross, half)
    c, s = np.cos(angle), np.sin(angle)
    v = np.array([[c, -s], [s, c]])
    return np.diag(v.T @ a @ v).copy(), v


def eigen(matrix: np.ndarray, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """(values falling, unit vectors as columns) of a symmetric matrix, by recursive splitting.

    Vectors of equal values are some orthonormal basis of their space.
    """
    matrix = 0.5 * (matrix + matrix.T)
    size, rng = np.linalg.norm(matrix), np.random.default_rng(seed)
    values, vectors = [], []
    pending = [np.eye(len(matrix))] if len(matrix) else []
    while pending:
        q = pending.pop()
        block = q.T @ matrix @ q
        block = 0.5 * (block + block.T)
        halves = None
        if len(block) == 2:
            e, v = _rotate(block)
            values.extend(e)
            vectors.extend((q @ v).T)
            continue
        if len(block) > 2:
            halves = _split(block, size, rng)
        if halves is None:
            values.extend(np.diag(block))
            vectors.extend(q.T)
        else:
            pending.extend(q @ h for h in halves)
    order = np.argsort(-np.array(values), kind="stable")
    v = np.array(vectors).reshape(-1, len(matrix))[order].T
    return _polish(matrix, v)


def _polish(matrix: np.ndarray, v: np.ndarray, rounds: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """First-order corrections of nearly exact eigenvectors; close values are left as they are."""
    size = np.linalg.norm(matrix)
    for _ in range(rounds):
        t = v.T @ matrix @ v
        e = np.diag(t)
        gap = e[None, :] - e[:, None]
        apart = np.abs(gap) > 1e3 * _EPS * max(size, np.finfo(np.float64).tiny)
        turn = np.where(apart, t / np.where(apart, gap, 1.0), 0.0)
        turn = np.where(np.abs(turn) < 1e-3, turn, 0.0)
        v, r = np.linalg.qr(v + v @ turn)
        v = v * np.where(np.diag(r) < 0, -1.0, 1.0)
    e = np.einsum("ij,ik,kj->j", v, matrix, v)
    order = np.argsort(-e, kind="stable")
    return e[order], v[:, order]


@dataclass(frozen=True)
class Whitening:
    """n vectors with sums S, and the leading components of their covariance."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums]) if self.n else np.zeros(0)


def integer_vectors(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(vec_id, x) with x = floor(scale * c) of each entry.

    Rows drop out whose vector is null or empty or has an entry that is null, not finite or beyond
    the whole numbers a double holds. A null vec_id stays.
    """
    v = F.col(vector)
    fit = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double") * scale) < _EXACT))
    x = F.transform(v, lambda c: F.floor(c.cast("double") * scale).cast("long"))
    return rows.filter(fit).select(F.col(vec_id).cast("long").alias("vec_id"), x.alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _added(rows: DataFrame, value: str) -> list:
    """Sums of the list column ``values`` place by place: its length in rows comes to the driver."""
    long = rows.select(F.posexplode("values").alias("i", "value"))
    return [r["s"] for r in long.groupBy("i").agg(F.sum(F.col("value").cast(value)).alias("s")).orderBy("i").collect()]


def _scatter(vectors: DataFrame, mean: np.ndarray, onto: np.ndarray | None = None, centre: np.ndarray | float = 0.0) -> np.ndarray:
    """Sum over all vectors of the products of their centred entries (or of their projections around a centre)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0.0
        for batch in batches:
            if batch.num_rows:
                y = _matrix(batch.column(0)) - mean
                y = y if onto is None else y @ onto - centre
                total = total + y.T @ y
        if not np.isscalar(total):
            yield pa.RecordBatch.from_arrays([pa.array([total.ravel()])], names=["values"])

    sums = np.array(_added(vectors.mapInArrow(run, "values array<double>"), "double"))
    width = len(mean) if onto is None else onto.shape[1]
    return sums.reshape(width, width)


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening:
    """Components of the distinct x vectors of (vec_id, x), all of one width."""
    distinct = durable(vectors.select("x").distinct())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, 0
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(0))
                # halves keep the partial sums of a batch within 64 bits
                high, low = x >> 32, x & 0xFFFFFFFF
                sums = sums + (high.sum(axis=0).astype(object) << 32) + low.sum(axis=0).astype(object)
                n += len(x)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([[str(s) for s in (n, *sums)]])], names=["values"])

    counted = [int(s) for s in _added(distinct.mapInArrow(count, "values array<string>"), "decimal(38,0)")]
    if not counted:
        return Whitening(0, [], np.zeros(0), np.zeros((0, 0)), 0.0, 0.0)
    n, sums = counted[0], counted[1:]
    mean = np.array([s / n for s in sums])
    covariance = _scatter(distinct, mean) / n
    trace = float(np.trace(covariance))
    values, basis = eigen(covariance)
    keep = values[:components] > _NO_VARIANCE * trace
    values, basis = values[:components][keep], basis[:, :components][:, keep]
    error = 0.0
    if len(values):
        scaled = basis / np.sqrt(values)
        found = _scatter(distinct, mean, scaled, _centre(distinct, mean, scaled) / n) / n
        error = float(np.abs(found - np.eye(len(values))).max())
    return Whitening(n, sums, values, basis, trace, error)


def _centre(vectors: DataFrame, mean: np.ndarray, onto: np.ndarray) -> np.ndarray:
    """Sum of the projections, zero but for rounding."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                total = ((_matrix(batch.column(0)) - mean) @ onto).sum(axis=0)
                yield pa.RecordBatch.from_arrays([pa.array([total])], names=["values"])

    return np.array(_added(vectors.mapInArrow(run, "values array<double>"), "double"))


def _deviation(x: np.ndarray, n: int, sums: list[int]) -> list:
    """Exact sum of (n*x - S)^2; None beyond 64 bits."""
    reach = max(abs(s) for s in sums) + n * int(np.abs(x).max())
    if reach * reach * len(sums) <= _LARGEST:
        return ((n * x - np.array(sums, dtype=np.int64)) ** 2).sum(axis=1).tolist()
    exact = ((n * x.astype(object) - np.array(sums, dtype=object)) ** 2).sum(axis=1)
    return [int(d) if d <= _LARGEST else None for d in exact]


def whiten(rows: DataFrame, components: int = COMPONENTS, vec_id: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error for each row and component.

    Repeated rows come out as often as they come in and count once in the fit, and so do different rows
    of equal vectors; a null vec_id stays null. Vectors whose width is not the most frequent one (the
    smaller at a tie) drop out. A component without variance has no rows, so one vector alone, or
    copies of one, give none, and neither does an empty table. A deviation beyond 64 bits is null.
    Other columns are not read.
    """
    read = integer_vectors(rows, vec_id, vector, scale)
    widths = read.groupBy(F.size("x").alias("width")).agg(F.count("*").alias("n"))
    most = widths.orderBy(F.desc("n"), "width").first()
    if most is not None:
        read = read.filter(F.size("x") == most["width"])
    model = fit(read, components)
    # a mean and at most ``components`` vectors of one width
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        k = len(m.values)
        scaled = m.vectors / np.sqrt(m.values) if k else None
        for batch in batches:
            if not batch.num_rows or not k:
                continue
            x = _matrix(batch.column(1))
            many = len(x)
            y = (x - m.mean) @ scaled
            columns = [
                batch.column(0).take(pa.array(np.repeat(np.arange(many), k))),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), many)),
                pa.array(np.full(many * k, m.n, dtype=np.int64)),
                pa.array([d for d in _deviation(x, m.n, m.sums) for _ in range(k)], pa.int64()),
                pa.array(y.ravel()),
                pa.array(np.tile(m.values / m.trace, many)),
                pa.array(np.full(many * k, m.identity_error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=_OUT)

    return read.mapInArrow(run, "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")


_OUT = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def query(spark, sf_dir):
    return whiten(table(spark, sf_dir, "embeddings"))
