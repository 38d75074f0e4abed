"""Exact top-k inner products over norm-sorted blocks.

Vectors are dealt by descending length into blocks. The block of the longest vectors gives
every query a first bound on its k-th best score; a block whose longest vector cannot reach
any bound of a query block is never paired with it, and inside a pair the scan stops at the
first vector too short for all queries left. What remains is tested in coordinates rotated by
the singular vectors of all rows: the leading coordinates give a partial sum, Cauchy-Schwarz
bounds the rest by the product of the residual lengths, and only pairs whose bound reaches
the k-th best score are multiplied out, in integers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larkspur.llm.common import table
from larkspur.session import durable

K = 10
SCALE = 1024
#: vectors and queries in a block, and vectors looked at between two bound updates
BLOCK, QUERIES, STEP = 4096, 2048, 512
#: above this share of survivors a dense product costs less than single ones
DENSE = 0.05

_EXACT = float(1 << 53)
_BLOB = "block long, rows int, width int, longest double, ids binary, vectors binary"


def integer_vectors(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(vec_id, v, norm): floor(scale * x) as whole doubles; vectors with null or non-finite parts are left out."""
    x = F.col(vector)
    fit = x.isNotNull() & F.col(vec_id).isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    v = F.transform(x, lambda c: F.rint(F.floor(c.cast("double") * scale).cast("double")))
    big = F.transform(x, lambda c: c.cast("double") * scale)  # from 2^53 on a double is whole
    v = F.zip_with(v, big, lambda small, large: F.when(F.abs(large) < _EXACT, small).otherwise(large))
    rows = rows.filter(fit).select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v"))
    return rows.withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, c: a + c * c)))


def rotation(vectors: DataFrame, width: int) -> np.ndarray:
    """Right singular vectors of all rows, strongest first, from the width x width Gram matrix."""

    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            m = _matrix(batch.column(0), width)
            total += m.T @ m
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel().tolist()], pa.list_(pa.float64()))], names=["g"])

    sums = vectors.select("v").mapInArrow(gram, "g array<double>").select(F.posexplode("g").alias("at", "x")).groupBy("at").agg(F.sum("x").alias("x"))
    g = np.zeros(width * width)
    for row in sums.collect():  # width * width numbers
        g[row["at"]] = row["x"]
    if not np.isfinite(g).all():
        return np.eye(width)
    return np.linalg.eigh(g.reshape(width, width))[1][:, ::-1].copy()


def _matrix(lists: pa.ListArray, width: int) -> np.ndarray:
    """Rows of doubles; missing trailing parts are zero."""
    out = np.zeros((len(lists), width))
    for row, values in zip(out, lists):
        own = values.values.to_numpy(zero_copy_only=False)
        row[: len(own)] = own
    return out


def blocks(vectors: DataFrame, width: int, per_block: int, parts: int) -> DataFrame:
    """Packed blocks whose numbers grow as the vectors get shorter."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, count = TaskContext.get().partitionId() << 32, 0
        ids, rows, norms = [], [], []

        def row(m: int):
            i, v = np.concatenate(ids), np.concatenate(rows)
            n = np.concatenate(norms)
            ids[:], rows[:], norms[:] = [i[m:]], [v[m:]], [n[m:]]
            return [part + count, len(v[:m]), width, float(n[0]), i[:m].tobytes(), v[:m].tobytes()]

        def out(r):
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(r, kinds)], names=["block", "rows", "width", "longest", "ids", "vectors"])

        held = 0
        for batch in batches:
            ids.append(batch.column(0).to_numpy(zero_copy_only=False))
            rows.append(_matrix(batch.column(1), width))
            norms.append(batch.column(2).to_numpy(zero_copy_only=False))
            held += len(batch)
            while held >= per_block:
                yield out(row(per_block))
                held, count = held - per_block, count + 1
        if held:
            yield out(row(held))

    order = [F.desc("norm"), F.asc("vec_id")]
    return durable(vectors.select("vec_id", "v", "norm").repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(packed, _BLOB))


def _best(q: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of each query's k best: high scores first, then small ids."""
    if scores.dtype == object:
        order = np.array(sorted(range(len(q)), key=lambda i: (q[i], -scores[i], ids[i])), dtype=np.int64)
    else:
        order = np.lexsort((ids, -scores, q))
    own = q[order]
    starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if len(own) else np.zeros(0, dtype=np.int64)
    rank = np.arange(len(own)) - np.repeat(starts, np.diff(np.r_[starts, len(own)]))
    return order[rank < k]


def search_block(queries, query_ids, bounds, vectors, vector_ids, turn, k: int = K):
    """(query places, vector ids, scores): each query's best rows of one norm-sorted block.

    ``bounds`` holds scores the queries reach elsewhere; what cannot reach them is left out.
    """
    width = vectors.shape[1]
    q_norm, v_norm = np.linalg.norm(queries, axis=1), np.linalg.norm(vectors, axis=1)
    whole = q_norm.max(initial=0.0) * v_norm.max(initial=0.0) < _EXACT
    rq, rv = queries @ turn, vectors @ turn
    cuts = sorted({max(width // 8, 1), max(width // 3, 1)} & set(range(1, width)))
    bounds = bounds.astype(float).copy()
    got_q, got_i, got_s = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64 if whole else object)
    for at in range(0, len(vectors), STEP):
        part = slice(at, at + STEP)
        reach = q_norm * v_norm[part].max()
        live = np.flatnonzero(reach * (1 + 1e-9) + 1e-6 >= bounds)
        if not len(live):
            break  # later vectors are shorter still
        slack = (q_norm[live, None] * v_norm[None, part]) * 1e-9 + 1e-6
        maybe = q_norm[live, None] * v_norm[None, part] + slack >= bounds[live, None]
        for cut in cuts:
            if maybe.mean() <= DENSE:
                break
            left_q, left_v = np.linalg.norm(rq[live, cut:], axis=1), np.linalg.norm(rv[part, cut:], axis=1)
            maybe &= rq[live, :cut] @ rv[part, :cut].T + left_q[:, None] * left_v[None, :] + slack >= bounds[live, None]
        i, j = np.nonzero(maybe)
        if not len(i):
            continue
        if not whole:
            exact = np.array([sum(int(a) * int(b) for a, b in zip(queries[live[a_]], vectors[at + b_])) for a_, b_ in zip(i, j)], dtype=object)
        elif maybe.mean() > DENSE:
            exact = np.rint(queries[live] @ vectors[part].T).astype(np.int64)[i, j]
        else:
            exact = np.rint(np.einsum("ij,ij->i", queries[live[i]], vectors[at + j])).astype(np.int64)
        other = query_ids[live[i]] != vector_ids[at + j]
        got_q, got_i = np.r_[got_q, live[i][other]], np.r_[got_i, vector_ids[at + j][other]]
        got_s = np.concatenate([got_s, exact[other]])
        keep = _best(got_q, got_i, got_s, k)
        got_q, got_i, got_s = got_q[keep], got_i[keep], got_s[keep]
        full, count = np.unique(got_q, return_counts=True)
        full = full[count == k]
        last = np.searchsorted(got_q, full, side="right") - 1
        bounds[full] = np.maximum(bounds[full], got_s[last].astype(float))
    return got_q, got_i, got_s


def _answers(pairs: DataFrame, turn: np.ndarray, k: int) -> DataFrame:
    """(query_id, vec_id, score) of pairs (width, ids, vectors, q_ids, q_vectors, q_bounds)."""
    low, high = -(1 << 63), (1 << 63) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, q_ids = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["q_ids"], np.int64)
                v = np.frombuffer(row["vectors"]).reshape(len(ids), -1)
                q = np.frombuffer(row["q_vectors"]).reshape(len(q_ids), -1)
                at, found, score = search_block(q, q_ids, np.frombuffer(row["q_bounds"]), v, ids, turn, k)
                score = np.array([min(max(int(s), low), high) for s in score], dtype=np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(q_ids[at]), pa.array(found.astype(np.int64)), pa.array(score)], names=["query_id", "vec_id", "score"])

    return pairs.select("ids", "vectors", "q_ids", "q_vectors", "q_bounds").mapInArrow(run, "query_id long, vec_id long, score long")


def _query_blocks(queries: DataFrame, width: int, count: int) -> DataFrame:
    """(q_block, reach, q_ids, q_vectors, q_bounds) from (vec_id, v, norm, bound).

    ``reach`` is the length a vector needs to matter to any query of the block. A block is the
    share of one hash value, about QUERIES rows.
    """

    def packed(key, frame):
        v = _matrix(frame.column("v").combine_chunks(), width)
        norm, bound = frame.column("norm").to_numpy(), frame.column("bound").to_numpy()
        need = np.where(norm > 0, bound / np.where(norm > 0, norm, 1.0), np.where(bound > 0, np.inf, -np.inf))
        cols = [[key[0].as_py()], [float(need.min())], [frame.column("vec_id").to_numpy().tobytes()], [v.tobytes()], [bound.tobytes()]]
        kinds = (pa.int32(), pa.float64(), pa.binary(), pa.binary(), pa.binary())
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=["q_block", "reach", "q_ids", "q_vectors", "q_bounds"])

    keyed = queries.withColumn("q_block", F.pmod(F.xxhash64("vec_id"), F.lit(count)).cast("int"))
    return durable(keyed.groupBy("q_block").applyInArrow(packed, "q_block int, reach double, q_ids binary, q_vectors binary, q_bounds binary"))


def top_k(rows: DataFrame, every: int, k: int = K, scale: int = SCALE, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) for the ids divisible by ``every``, against all rows.

    Rows without an id, and vectors that are null or hold null or non-finite parts, take no
    part; a shorter vector counts as ending in zeros. Rows that repeat an id are candidates
    each, but never of a query of that id, which is searched once, with the least of its
    vectors. Equal scores go to smaller ids. Scores beyond a long stand at its limit. No
    rows give no answers.
    """
    vectors = durable(integer_vectors(rows, vec_id, vector, scale))
    stats = vectors.agg(F.count("*").alias("n"), F.coalesce(F.max(F.size("v")), F.lit(0)).alias("width"), F.count(F.when(F.col("vec_id") % every == 0, 1)).alias("q")).first()
    width = max(stats["width"], 1)
    turn = rotation(vectors, width)
    dealt = blocks(vectors, width, BLOCK, max(math.ceil(stats["n"] / BLOCK), 1))
    asked = vectors.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v"))
    asked = durable(asked.withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, c: a + c * c))))
    count = max(math.ceil(stats["q"] / QUERIES), 1)
    top = dealt.agg(F.min("block")).first()[0]
    first = _query_blocks(asked.withColumn("bound", F.lit(float("-inf"))), width, count)
    opening = durable(_answers(_paired(dealt.filter(F.col("block") == F.lit(top)), first, count), turn, k))
    reached = opening.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").cast("double").alias("least"))
    bound = F.when(F.col("n") >= k, F.col("least")).otherwise(float("-inf"))
    later = asked.join(reached, F.col("vec_id") == F.col("query_id"), "left").select("vec_id", "v", "norm", bound.alias("bound"))
    rest = _answers(_paired(dealt.filter(F.col("block") != F.lit(top)), _query_blocks(later, width, count), count), turn, k)
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return opening.unionByName(rest).withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _paired(dealt: DataFrame, asked: DataFrame, count: int) -> DataFrame:
    """Blocks beside the query blocks some query of which they may answer; numbers meet before vectors do."""
    meta = dealt.select("block", "longest", F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias("q_block"))
    wanted = meta.join(asked.select("q_block", "reach"), "q_block").filter(F.col("longest") * (1 + 1e-9) + 1e-6 >= F.col("reach"))
    return asked.join(wanted.select("block", "q_block"), "q_block").join(dealt, "block")


def query(spark, sf_dir):
    return top_k(table(spark, sf_dir, "embeddings"), every=100)


ORACLE_SQL = f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= {K}
"""
