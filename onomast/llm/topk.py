"""Exact nearest vectors by inner product, with multi-resolution segment statistics.

A vector is cut into segments; of each only the mean and the deviation (the norm of what the mean leaves) are kept. The
inner product of two vectors is at most the sum over segments of ``n * mean * mean + deviation * deviation``, which is to
say that their distance is at least what those statistics give. Bounds are taken from coarse to fine: 1, 4, then 16
segments; a candidate goes as soon as a bound puts it behind the k-th best score known. Survivors are scored exactly.

Queries and vectors meet block by block; both sides of a block have a fixed number of rows, so neither side is broadcast
and memory does not grow with the data. A vector is sent once for each block of queries, and there meets thousands of them;
each block sends k rows a query on.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SEGMENTS = (1, 4, 16)
ROWS_PER_BLOCK = 8192
QUERIES_PER_BLOCK = 8192
_EXACT = float(1 << 53)


def quantised(flat: np.ndarray, n: int) -> np.ndarray:
    """floor(1024 x) of n vectors; int64 where that is exact, Python integers otherwise."""
    out = np.floor(flat.astype(np.float64).reshape(n, -1) * 1024)
    return out.astype(np.int64) if not out.size or np.abs(out).max() < _EXACT else np.array([[int(v) for v in row] for row in out], object)


def statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Per segment sqrt(n) * mean and the deviation: the inner product of two such rows bounds that of the vectors."""
    parts = [p for p in np.array_split(x, min(segments, max(1, x.shape[1])), axis=1) if p.shape[1]]
    means = [p.mean(axis=1, keepdims=True) for p in parts]
    return np.hstack([m * np.sqrt(p.shape[1]) for m, p in zip(means, parts, strict=True)] + [np.sqrt(((p - m) ** 2).sum(axis=1, keepdims=True)) for m, p in zip(means, parts, strict=True)]) if parts else np.zeros((len(x), 1))


def block_top(qid: np.ndarray, q: np.ndarray, xid: np.ndarray, x: np.ndarray, k: int, levels: Sequence[int] = SEGMENTS) -> list[tuple[int, int, int]]:
    """(query, vector, score) of the k best of one block for each query; ties to the smaller id, the query's own id excluded."""
    out: list[tuple[int, int, int]] = []
    order = np.argsort(xid, kind="stable")
    xid, x = xid[order], x[order]
    if q.dtype == object or x.dtype == object or (q.size and x.size and float(np.abs(q).max()) * float(np.abs(x).max()) * x.shape[1] >= _EXACT):
        for i, row in zip(qid.tolist(), q.astype(object), strict=True):
            scores = [(-min(max(int(np.dot(row, v)), -(1 << 63)), (1 << 63) - 1), j) for j, v in zip(xid.tolist(), x.astype(object), strict=True) if i != j]
            out += [(i, j, -s) for s, j in sorted(scores)[:k]]
        return out
    qf, xf = q.astype(np.float64), x.astype(np.float64)
    coarse_to_fine = [(statistics(qf, s), statistics(xf, s)) for s in levels]
    slack = 1e-9 * (1 + np.sqrt((qf**2).sum(axis=1)) * np.sqrt((xf**2).sum(axis=1).max(initial=0)))
    first = 4 * k
    for at in range(0, len(qid), 256):
        bounds = coarse_to_fine[0][0][at : at + 256] @ coarse_to_fine[0][1].T
        for r, bound in enumerate(bounds):
            i = at + r
            own = np.flatnonzero(xid != qid[i])
            if len(own) > first:
                bound = bound[own]
                seen = own[np.argpartition(bound, len(own) - first)[len(own) - first :]]
                least = np.partition(xf[seen] @ qf[i], first - k)[first - k] - slack[i]  # k-th best score so far
                own = own[bound >= least]
                for qs, xs in coarse_to_fine[1:]:
                    own = own[xs[own] @ qs[i] >= least]
            scores = xf[own] @ qf[i]
            best = np.lexsort((xid[own], -scores))[:k]
            out += [(int(qid[i]), int(xid[own[b]]), int(scores[b])) for b in best]
    return out


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", rows_per_block: int = ROWS_PER_BLOCK, queries_per_block: int = QUERIES_PER_BLOCK) -> DataFrame:
    """For each query its k best rows of ``vectors``: query_id, rank (from 1), vec_id, score.

    Components become ``floor(1024 * x)``; the score is the integer inner product, equal scores go to the smaller id, and
    rows with the query's own id are no candidates. Vectors (and ids) that are null, or hold null or non-finite
    components, take no part; vectors of different lengths are never compared. Repeated rows of ``vectors`` count each;
    of queries with one id the least vector counts. Scores beyond a long are cut to it. Other columns play no part.
    """
    ok = F.col("id").isNotNull() & F.col("v").isNotNull() & ~F.coalesce(F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))), F.lit(True))
    take = lambda df: df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")).where(ok).withColumn("dim", F.size("v"))
    rows = take(vectors)
    asked = take(queries).groupBy("id", "dim").agg(F.min("v").alias("v")).withColumn("one", F.row_number().over(Window.partitionBy("id").orderBy("v"))).where("one = 1").drop("one")
    row_blocks = max(1, -(-vectors.count() // rows_per_block))
    query_blocks = max(1, -(-queries.count() // queries_per_block))
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    rows = rows.withColumn("rb", F.pmod(F.xxhash64("id", "v"), F.lit(row_blocks)).cast("int")).withColumn("qb", spread(query_blocks))
    asked = asked.withColumn("qb", F.pmod(F.xxhash64("id"), F.lit(query_blocks)).cast("int")).withColumn("rb", spread(row_blocks))

    def run(q: pa.Table, x: pa.Table) -> pa.Table:
        found = []
        if q.num_rows and x.num_rows:
            flat = [np.asarray(t["v"].combine_chunks().flatten()) for t in (q, x)]
            found = block_top(q["id"].to_numpy(), quantised(flat[0], q.num_rows), x["id"].to_numpy(), quantised(flat[1], x.num_rows), k)
        cols = list(zip(*found, strict=True)) or [(), (), ()]
        return pa.table([pa.array(c, pa.int64()) for c in cols], ["query_id", "vec_id", "score"])

    keys = ("dim", "qb", "rb")
    near = asked.groupBy(*keys).cogroup(rows.groupBy(*keys)).applyInArrow(run, "query_id bigint, vec_id bigint, score bigint")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return near.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
