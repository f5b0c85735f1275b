"""Exact top-k search by aggregating sorted lists without random access.

For a query q and a set of vectors, each dimension d is a list of the vectors
sorted by their contribution q_d * x_d: by x_d from the top where q_d > 0, from
the bottom where q_d < 0.  The lists are read in parallel, from the best entry
down.  At any depth a vector's score lies between

* lower bound: what its seen entries contribute, and the worst entry of each
  list in which it has not been seen;
* upper bound: what its seen entries contribute, and the last entry read of
  each list in which it has not been seen.

The k-th best lower bound is a threshold: a vector (seen or not) whose upper
bound is below it can't qualify.  Reading stops as soon as few enough are
left, at the lists' end at the latest, where both bounds are the score; only
the scores of those left are resolved.

Spark deals queries and vectors into blocks (by a hash of their place, so
that repeated vectors spread evenly) and joins each query block with each
vector block: a stated query set against all rows.  Inside a task a block's
lists are read in steps of depth, for all queries at once: after each step
both bounds of all vectors are matrix products of clipped values (a vector's
entry has been seen iff its value has reached the list's frontier).  Each
block returns at most k rows a query; a window merges them.

Integer components keep the products exact: in 32-bit floats while d * max^2
is below 2^24, in 64-bit below 2^53, in Python integers above.

Edge cases: vectors that are null or hold a null or non-finite component take
no part, nor do rows without id; rows that repeat both id and vector are one
row, rows that share an id with other vectors are rows of their own; shorter
vectors count as padded with zeros; fewer than k candidates give fewer rows;
ties go to the smaller id; no queries or no rows give an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from recspark.llm.common import cut

K = 20
DEPTHS = (0.5, 0.75, 0.9, 1.0)  # of the lists, at which bounds are taken
FEW = 0.02               # share of the vectors that may be left to resolve
QUERY_BLOCK = 512
ROW_BLOCK = 4096
OUT = "query_id long, query_place long, vec_id long, place long, score long"


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    rows = column.to_pylist()
    big = max((max(map(abs, r), default=0) for r in rows), default=0)
    kind = np.float32 if width * big * big < 1 << 24 else np.float64 if width * big * big < 1 << 53 else object
    out = np.zeros((len(rows), width), kind)
    for i, r in enumerate(rows):
        out[i, :len(r)] = r
    return out


def bounded(q: np.ndarray, x: np.ndarray, alive: np.ndarray, k: int) -> np.ndarray:
    """``alive`` (query, row) without those that the bounds rule out."""
    n = len(x)
    up, down = np.maximum(q, 0), np.minimum(q, 0)
    lists = np.sort(x, axis=0)
    for depth in DEPTHS:
        t = min(n - 1, int(depth * n))
        high, low = lists[n - 1 - t], lists[t]              # frontiers
        best = up @ np.maximum(x, high).T + down @ np.minimum(x, low).T
        worst = up @ np.where(x >= high, x, lists[0]).T + down @ np.where(x <= low, x, lists[-1]).T
        worst[~alive] = -np.inf
        threshold = np.partition(worst, n - k, axis=1)[:, n - k]
        alive = alive & (best >= threshold[:, None])
        if alive.mean() <= FEW:
            break
    return alive


def search(q: np.ndarray, x: np.ndarray, own: np.ndarray, ids: np.ndarray, k: int = K) -> list[tuple[int, int, int]]:
    """(query, row, score) of each query's k best rows; ``own`` is the row of
    the query itself (-1: not here); ties go to the smaller id."""
    m, n = len(q), len(x)
    alive = np.ones((m, n), bool)
    here = np.flatnonzero(own >= 0)
    alive[here, own[here]] = False
    if q.dtype != object and x.dtype != object and n > k + 1:
        alive = bounded(q, x, alive, k)
    at = np.nonzero(alive)
    step = 1 << 18
    parts = [(q[at[0][i:i + step]] * x[at[1][i:i + step]]).sum(1) for i in range(0, len(at[0]), step)]
    score = np.concatenate(parts) if parts else np.zeros(0)
    out = []
    start = np.searchsorted(at[0], np.arange(m + 1))
    for i in range(m):
        rows = range(start[i], start[i + 1])
        for j in sorted(rows, key=lambda j: (-int(score[j]), ids[at[1][j]], at[1][j]))[:k]:
            out.append((i, int(at[1][j]), int(score[j])))
    return out


def _block(k: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        left, right = left.combine_chunks(), right.combine_chunks()
        names = [c.split()[0] for c in OUT.split(", ")]
        if not left.num_rows or not right.num_rows:
            rows = []
        else:
            width = max(max(map(len, t.column("v").to_pylist()), default=0) for t in (left, right))
            q, x = _matrix(left.column("v"), width), _matrix(right.column("v"), width)
            if q.dtype != x.dtype:
                kind = object if object in (q.dtype, x.dtype) else np.float64
                q, x = q.astype(kind), x.astype(kind)
            elif len(q) and q.dtype != object and width * float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) >= 1 << 24:
                q, x = q.astype(np.float64), x.astype(np.float64)
            qid, qp = left.column("vec_id").to_pylist(), left.column("place").to_pylist()
            ids, places = right.column("vec_id").to_numpy(), right.column("place").to_pylist()
            where = {p: i for i, p in enumerate(places)}
            own = np.array([where.get(p, -1) for p in qp])
            most = (1 << 63) - 1  # a score beyond 64 bits saturates
            rows = [(qid[i], qp[i], int(ids[j]), places[j], max(-most, min(most, s))) for i, j, s in search(q, x, own, ids, k)]
        cols = list(zip(*rows)) or [()] * 5
        return pa.table([pa.array(c, pa.int64()) for c in cols], names=names)
    return run


def vectors(rows: DataFrame, scale: int = 64) -> DataFrame:
    """vec_id, v: floor(scale * x) of every component of the rows that take part."""
    x = F.col("embedding")
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return (rows.where(F.col("vec_id").isNotNull() & x.isNotNull()).where(fine)
            .select(F.col("vec_id").cast("long").alias("vec_id"),
                    F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("long")).alias("v")))


def top_k(rows: DataFrame, is_query, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score of the k largest inner products of each
    query row (``is_query`` on vec_id) with all other rows."""
    placed = cut(rows.groupBy("vec_id", F.xxhash64("v").alias("h")).agg(F.first("v").alias("v")).drop("h")
                 .withColumn("place", F.monotonically_increasing_id()))
    n, nq = placed.agg(F.count("*"), F.count_if(is_query)).first()
    row_blocks, query_blocks = max(1, math.ceil(n / ROW_BLOCK)), max(1, math.ceil(nq / QUERY_BLOCK))
    spread = lambda blocks, seed: F.pmod(F.xxhash64("place", F.lit(seed)), F.lit(blocks)).cast("int")
    every = lambda blocks: F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    left = placed.where(is_query).withColumn("qb", spread(query_blocks, 1)).withColumn("rb", every(row_blocks))
    right = placed.withColumn("rb", spread(row_blocks, 2)).withColumn("qb", every(query_blocks))
    found = left.groupBy("qb", "rb").cogroup(right.groupBy("qb", "rb")).applyInArrow(_block(k), OUT)
    best = W.partitionBy("query_id", "query_place").orderBy(F.desc("score"), "vec_id", "place")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


SQL = r"""
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
s AS (SELECT q.vec_id AS query_id, e.vec_id, list_dot_product(q.v::DOUBLE[], e.v::DOUBLE[])::BIGINT AS score
      FROM e q JOIN e ON e.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, rank::INT AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20
"""
