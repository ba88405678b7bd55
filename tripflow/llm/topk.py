"""Exact top-k search by inner product with Fagin's threshold algorithm.

Candidates are dealt into blocks of bounded size, queries likewise, and every pair of blocks is
one unit of work. In a block each dimension has a list of candidates sorted by their component.
The threshold algorithm reads all lists in step, each from the end that the sign of the query's
component asks for; whatever it meets for the first time is scored in full. The sum over the
dimensions of query component times the value now reached bounds every candidate not yet met. A
query stops when that bound is below its kth score so far (at equality a smaller id could still
win). Queries of a block go down the lists together, in growing steps; each stops by itself.

The k best of each pair of blocks, k rows per query and candidate block, are then merged by query.

Arithmetic is exact: integers, in double precision while products fit, else in Python integers.

Defined results: vectors that are null or hold a null or non-finite component take no part,
nor do rows with a null id; a shorter vector, an empty one too, counts as padded with zeros; rows that repeat are
candidates of their own, and a query's own row alone is left out; equal scores and ids rank by
position in the input; components and scores beyond 64 bits count as the largest number of 64
bits; an empty table has an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tripflow.llm.common import written

K = 20
QUERY_EVERY = 20
SCALE = 64
BLOCK = 2048            # candidates in a block
QUERY_BLOCK = 512       # queries in a block
STEP = 4                # the depth that is read grows by this factor
LONG = 2 ** 63 - 1
EXACT = 2.0 ** 52       # doubles hold integers exactly below this


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """row, vec_id and x (array of whole numbers as doubles) of the vectors that take part."""
    x = F.col("embedding").cast("array<double>")
    whole = F.transform(x, lambda v: F.floor(v * F.lit(float(scale))).cast("double"))
    sound = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))))
    return vectors.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"),
                          F.when(sound, whole).alias("x")).where(
        F.col("x").isNotNull() & F.col("vec_id").isNotNull())


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows, padded with zeros."""
    column = column.combine_chunks()
    sizes = np.asarray(pa.compute.list_value_length(column))
    out = np.zeros((len(sizes), width))
    flat = np.asarray(column.flatten(), np.float64)
    at = np.repeat(np.arange(len(sizes)), sizes)
    out[at, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def search(queries: np.ndarray, own: np.ndarray, x: np.ndarray, rows: np.ndarray, k: int = K,
           reads: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(scores, positions) of the k best of ``x`` for each query; position -1 where there are fewer.

    ``x`` is in order of id, so that of equal scores the first position wins. ``own`` and ``rows``
    tell a query's own row. ``reads`` collects how many candidates were scored for the queries.
    """
    n, dims = x.shape
    order = np.argsort(x, axis=0, kind="stable")      # per dimension: candidates by component
    ranked = np.take_along_axis(x, order, axis=0)
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    biggest = float(np.abs(queries).max(initial=0) * np.abs(x).max(initial=0) * dims + 1)
    if biggest * n >= EXACT:                          # beyond doubles: whole numbers of any size
        queries, x, ranked = (np.vectorize(int, otypes=[object])(a) for a in (queries, x, ranked))
        up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    none = -biggest * 2 if queries.dtype != object else -int(biggest) * 2
    score = np.full((len(queries), k), none, queries.dtype)
    place = np.full((len(queries), k), -1, np.int64)
    active, seen, depth, before = np.arange(len(queries)), np.zeros(n, bool), 1, 0
    while len(active) and before < n:
        depth = min(depth, n)
        # the lists that active queries read: from the top where a component is positive, from the
        # bottom where it is negative; reading both ends only scores more than is needed
        met = np.zeros(n, bool)
        met[order[n - depth:n - before][:, (up[active] > 0).any(0)].ravel()] = True
        met[order[before:depth][:, (down[active] < 0).any(0)].ravel()] = True
        if depth == n:
            met[:] = True                             # components of zero bound nothing away
        new = np.nonzero(met & ~seen)[0]
        seen[new] = True
        if len(new):
            if reads is not None:
                reads.append(len(new) * len(active))
            s = queries[active] @ x[new].T
            s[own[active][:, None] == rows[new][None, :]] = none
            # one number that orders by score, then by position
            key = np.concatenate([score[active], s], 1)
            at = np.concatenate([place[active], np.broadcast_to(new, s.shape)], 1)
            both = key * n - np.where(at < 0, n, at)
            best = np.argsort(-both, axis=1, kind="stable")[:, :k] if both.dtype == object or both.shape[1] <= 2 * k \
                else _best(both, k)
            score[active] = np.take_along_axis(key, best, 1)
            place[active] = np.take_along_axis(at, best, 1)
            place[active] = np.where(score[active] <= none, -1, place[active])
        # no candidate that was not met can score more than this
        bound = up[active] @ ranked[n - depth] + down[active] @ ranked[depth - 1]
        active = active[(bound >= score[active, k - 1]) if queries.dtype != object else
                        np.array([b >= s for b, s in zip(bound, score[active, k - 1], strict=True)], bool)]
        before, depth = depth, depth * STEP
    return score, place


def _best(both: np.ndarray, k: int) -> np.ndarray:
    part = np.argpartition(-both, k - 1, axis=1)[:, :k]
    inner = np.argsort(-np.take_along_axis(both, part, 1), axis=1, kind="stable")
    return np.take_along_axis(part, inner, 1)


def _pair(k: int):
    def run(_, queries: pa.Table, candidates: pa.Table) -> pa.Table:
        names = ["query_row", "query_id", "score", "vec_id", "vec_row"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        out: list[list] = [[], [], [], [], []]
        if queries.num_rows and candidates.num_rows:
            candidates = candidates.sort_by([("c_id", "ascending"), ("c_row", "ascending")])
            width = max(max(pa.compute.max(pa.compute.list_value_length(c)).as_py() for c in (queries.column("x"), candidates.column("c_x"))), 1)
            rows, ids = candidates.column("c_row").to_numpy(), candidates.column("c_id").to_numpy()
            own = queries.column("row").to_numpy()
            score, place = search(_matrix(queries.column("x"), width), own, _matrix(candidates.column("c_x"), width), rows, k)
            q, j = np.nonzero(place >= 0)
            at = place[q, j]
            out = [own[q], queries.column("vec_id").to_numpy()[q], [max(-LONG, min(LONG, int(s))) for s in score[q, j]], ids[at], rows[at]]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names=names)
    return run


def top_k(vectors: DataFrame, k: int = K, query_every: int = QUERY_EVERY, scale: int = SCALE, block: int = BLOCK,
          query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of each query's k best candidates.

    Queries are the rows whose id is divisible by ``query_every``. Each query block meets each
    candidate block, so the copies of a vector that are shuffled are the blocks of the other side:
    the product of both sizes over the block size, which is what an exact search of a stated
    query set costs at least.
    """
    rows = written(quantised(vectors, scale), "topk-vectors")
    asks = rows.where(F.col("vec_id") % query_every == 0)
    sizes = rows.agg(F.count("*").alias("n"), F.count(F.when(F.col("vec_id") % query_every == 0, 1)).alias("q")).first()
    n_blocks, q_blocks = max(1, math.ceil(sizes.n / block)), max(1, math.ceil(sizes.q / query_block))
    own = F.pmod(F.xxhash64("row"), F.lit(n_blocks)).cast("int")
    own_q = F.pmod(F.xxhash64("row", F.lit(1)), F.lit(q_blocks)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    left = asks.withColumn("qb", own_q).withColumn("cb", every(n_blocks)).groupBy("qb", "cb")
    # columns of their own: both sides come from one table
    right = rows.select(F.col("row").alias("c_row"), F.col("vec_id").alias("c_id"), F.col("x").alias("c_x"),
                        own.alias("c_block")).withColumn("q_block", every(q_blocks)).groupBy("q_block", "c_block")
    found = left.cogroup(right).applyInArrow(
        _pair(k), "query_row long, query_id long, score long, vec_id long, vec_row long")
    order = W.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "vec_row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
