"""Operator 1: exact top-k inner products with multi-resolution segment statistics.

Vectors are cut into 1, 4, 16, ... segments. With a segment's length l, means
m and deviations s, the squared distance of two vectors is at least the sum of
``l * ((m_q - m_x)**2 + (s_q - s_x)**2)``; as ``2 q.x = |q|^2 + |x|^2 - d^2``,
the inner product is at most the sum of ``l * (m_q * m_x + s_q * s_x)``. Coarse
levels come first; vectors whose bound lies below a query's k-th best score so
far drop out, and the scores of the rest are computed exactly.

Queries and vectors are dealt into blocks of bounded size; each pair of blocks
is one group that returns k rows a query, and a ranked window merges them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

VECTOR_BLOCK = 8192
QUERY_BLOCK = 512


def integer_vector(vector: Column, scale: int = 1024) -> Column:
    """floor(scale * x) of every component; null where the vector or a component is null or not finite."""
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.when(usable, F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long")))


def _levels(dim: int) -> list[np.ndarray]:
    """Segment borders of each resolution, coarse to fine."""
    counts = [n for n in (1, 4, 16, 64, 256) if n <= dim // 2]
    return [np.linspace(0, dim, n + 1).astype(int) for n in counts]


def _statistics(x: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """Rows whose products bound the inner product: sqrt(l) times means and deviations."""
    length = np.diff(borders).astype(float)
    mean = np.add.reduceat(x, borders[:-1], axis=1) / length
    square = np.add.reduceat(x * x, borders[:-1], axis=1) / length
    return np.hstack([mean * np.sqrt(length), np.sqrt(np.maximum(square - mean * mean, 0) * length)])


def block_topk(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int):
    """(query row, vector row, score) of each query's ``k`` best vectors of the block, own id excluded.

    Ties go to the smaller id. Scores are exact: in doubles while they stay
    below 2**53, else in Python's integers (cut to the range of a long).
    """
    order = np.argsort(ids, kind="stable")
    ids, x = ids[order], x[order]
    dim = x.shape[1]
    peak = max((int(abs(int(f(v)))) for v in (q, x) if v.size for f in (np.min, np.max)), default=0)
    small = peak * peak * max(dim, 1) < 1 << 53
    a, b = (q.astype(float), x.astype(float)) if small else (q.astype(object), x.astype(object))
    own = q_ids[:, None] == ids[None, :]
    alive = ~own
    cols = np.arange(len(ids))
    if small and len(ids) > 4 * k:
        slack = 1e-9 * (peak * peak * dim + 1)
        floor = np.full(len(q_ids), -np.inf)
        for borders in _levels(dim):
            bound = _statistics(a, borders) @ _statistics(b[cols], borders).T
            bound[~alive[:, cols]] = -np.inf
            seeds = np.argpartition(-bound, k, axis=1)[:, :k] if len(cols) > k else np.tile(np.arange(len(cols)), (len(a), 1))
            kept = np.take_along_axis(bound, seeds, 1) > -np.inf
            seen = np.where(kept, np.einsum("qd,qsd->qs", a, b[cols[seeds]]), -np.inf)
            floor = np.maximum(floor, seen.min(axis=1))
            alive[:, cols] &= bound >= floor[:, None] - slack
            cols = cols[alive[:, cols].any(axis=0)]
    scores = a @ b[cols].T
    for i in range(len(q_ids)):
        own_cols = np.flatnonzero(alive[i, cols])
        s = scores[i, own_cols]
        if len(s) > k and small:
            best = s >= np.partition(s, len(s) - k)[len(s) - k]
            own_cols, s = own_cols[best], s[best]
        for j in np.argsort(-s, kind="stable")[:k]:
            yield i, order[cols[own_cols[j]]], max(-(1 << 63), min((1 << 63) - 1, int(s[j])))


def _matrix(table: pa.Table, dim: int) -> tuple[np.ndarray, np.ndarray]:
    flat = table.column("vec").combine_chunks()
    flat = flat.flatten() if len(table) else pa.array([], pa.int64())
    return table.column("vec_id").to_numpy(), flat.to_numpy(zero_copy_only=False).reshape(len(table), dim)


def exact_topk(queries: DataFrame, vectors: DataFrame, k: int = 10) -> DataFrame:
    """Each query's ``k`` highest integer inner products among ``vectors``: query_id, rank, vec_id, score.

    Both tables have vec_id (long) and vec (array<long>, see
    ``integer_vector``). Rows with a null id or vector take no part; vectors
    match only queries of the same length (empty ones too, with score 0). A
    query's own id is no candidate; with fewer than ``k`` candidates all are
    returned, with none no row. Ties go to the smaller vec_id. Repeated rows
    are candidates each; a query id with several distinct vectors gets a list
    for each of them, and repeated equal queries get one. Empty tables give an
    empty result. Other columns are not read.
    """
    usable = lambda df: df.select("vec_id", "vec").filter("vec_id is not null and vec is not null")
    queries, vectors = usable(queries).distinct(), usable(vectors)
    blocks = lambda df, size: max(1, -(-df.count() // size))
    n_q, n_v = blocks(queries, QUERY_BLOCK), blocks(vectors, VECTOR_BLOCK)
    keys = ["dim", "q_block", "v_block"]
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = lambda df: df.withColumn("dim", F.size("vec"))
    left = (dealt(queries).withColumn("q_block", F.pmod(F.xxhash64("vec_id", "vec"), F.lit(n_q)).cast("int"))
            .withColumn("v_block", numbers(n_v)))
    right = (dealt(vectors).withColumn("v_block", F.pmod(F.monotonically_increasing_id(), F.lit(n_v)).cast("int"))
             .withColumn("q_block", numbers(n_q)))

    def run(key, qs, xs):
        out: list = []
        if len(qs) and len(xs):
            q_ids, q = _matrix(qs, key[0].as_py())
            ids, x = _matrix(xs, key[0].as_py())
            out = [(q_ids[i], q[i], ids[j], s) for i, j, s in block_topk(q_ids, q, ids, x, k)]
        return pa.table({
            "query_id": pa.array([r[0] for r in out], pa.int64()),
            "query": pa.array([r[1] for r in out], pa.list_(pa.int64())),
            "vec_id": pa.array([r[2] for r in out], pa.int64()),
            "score": pa.array([r[3] for r in out], pa.int64())})

    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        run, "query_id long, query array<long>, vec_id long, score long")
    best = W.partitionBy("query_id", "query").orderBy(F.desc("score"), F.asc("vec_id"))
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
