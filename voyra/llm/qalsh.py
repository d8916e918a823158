"""Approximate nearest neighbours by collision counting (query-aware hashing).

Every vector has one value on each of ``PROJECTIONS`` random lines. Vectors are
held in blocks; in a block each line is a sorted array. A query opens a window
around its own value on every line and widens all windows round by round
(virtual rehashing: the radius grows by ``GROWTH``, nothing is hashed again).
A vector that lies in the windows of at least ``THRESHOLD`` of the lines is
verified with its exact distance. A query is done in a block when its k-th best
verified distance is below the radius at which nearly every closer vector has
been counted (``SAFE`` times the half-width; a vector at that distance falls
into a window with probability 0.63, well above the threshold), or when every
vector is verified.

Queries meet every block of vectors, in blocks of their own; each block gives
at most k rows for a query, and the k best of these are the result.

Defined results: vectors that are null, empty, zero or hold null or non-finite
parts take no part; vectors are compared with those of the same length; equal
distances go to the smaller id; rows with the query's id are its own; rows that
repeat an id are one vector with several places, and one query: a neighbour counts
once, with the smallest distance of any of its rows to any of the query's; fewer
than k candidates give all of them; an empty table gives an empty result;
further columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

PROJECTIONS = 64
THRESHOLD = 0.5
GROWTH = 1.3
SAFE = 1.1
BLOCK_VECTORS = 8192
BLOCK_QUERIES = 1024


def _usable(v: Column) -> Column:
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.isNotNull() & (F.size(v) > 0) & ~bad & F.exists(v, lambda x: x != 0)


def _nearest_rows(ids: np.ndarray, dist: np.ndarray) -> np.ndarray:
    """Places of the rows by distance, then id; of each id only the nearest row."""
    order = np.lexsort((ids, dist))
    return order[np.sort(np.unique(ids[order], return_index=True)[1])]


def _search(ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, q: np.ndarray, k: int,
            projections: int = PROJECTIONS) -> tuple[list, list, list]:
    """The k best found for each query among one block of vectors."""
    n, dim = x.shape
    lines = np.random.default_rng(dim).standard_normal((dim, projections))
    values, own = x @ lines, q @ lines
    order = np.argsort(values, axis=0, kind="stable").T.copy()
    arrays = np.take_along_axis(values.T, order, axis=1)
    need = int(np.ceil(THRESHOLD * projections))
    again = len(np.unique(ids)) < n
    first = max(float(values.std()) * 0.1, 1e-12)
    out_q, out_v, out_s = [], [], []
    for i in range(len(q)):
        mid = np.array([np.searchsorted(a, p) for a, p in zip(arrays, own[i])])
        lo, hi = mid.copy(), mid.copy()
        count, seen = np.zeros(n, np.int32), ids == query_ids[i]
        found, dist = [], []
        half, kth = first, np.inf
        while True:
            new = []
            for j in range(projections):
                a, b = np.searchsorted(arrays[j], (own[i, j] - half, own[i, j] + half))
                b = max(b, hi[j])
                a = min(a, lo[j])
                new += [order[j, a: lo[j]], order[j, hi[j]: b]]
                lo[j], hi[j] = a, b
            count += np.bincount(np.concatenate(new), minlength=n).astype(np.int32)
            hit = np.flatnonzero((count >= need) & ~seen)
            if len(hit):
                seen[hit] = True
                found.append(hit)
                dist.append(np.sqrt(((x[hit] - q[i]) ** 2).sum(axis=1)))
                every = np.concatenate(dist)
                if again:
                    every = every[_nearest_rows(ids[np.concatenate(found)], every)]
                kth = np.partition(every, k - 1)[k - 1] if len(every) >= k else np.inf
            if kth <= SAFE * half or seen.all():
                break
            half *= GROWTH
        if found:
            f, d = np.concatenate(found), np.concatenate(dist)
            best = _nearest_rows(ids[f], d)[:k]
            out_q += [int(query_ids[i])] * len(best)
            out_v += ids[f[best]].tolist()
            out_s += d[best].tolist()
    return out_q, out_v, out_s


def _matrix(col: pa.ChunkedArray) -> np.ndarray:
    lists = col.combine_chunks()
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), -1)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id",
            vector: str = "embedding", block_vectors: int = BLOCK_VECTORS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of ``vectors`` for each id of ``queries``."""
    def rows(df: DataFrame) -> DataFrame:
        return df.filter(_usable(F.col(vector)) & F.col(id_col).isNotNull()).select(
            F.col(id_col).cast("long").alias("id"), F.size(vector).alias("dim"), F.col(vector).alias("v"))
    base, asked = rows(vectors), rows(queries)
    blocks = max(1, -(-base.count() // block_vectors))
    query_blocks = max(1, -(-asked.count() // BLOCK_QUERIES))

    def spread(df: DataFrame, mine: str, n: int, other: str, m: int) -> DataFrame:
        return (df.withColumn(mine, F.pmod(F.xxhash64("id"), F.lit(n)).cast("int"))
                .withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(m - 1)))))
    left = spread(base, "block", blocks, "query_block", query_blocks)
    right = spread(asked, "query_block", query_blocks, "block", blocks)

    def search(a: pa.Table, b: pa.Table) -> pa.Table:
        q = v = s = []
        if len(a) and len(b):
            q, v, s = _search(a.column("id").to_numpy(), _matrix(a.column("v")), b.column("id").to_numpy(), _matrix(b.column("v")), k)
        return pa.table({"query_id": pa.array(q, pa.int64()), "vec_id": pa.array(v, pa.int64()), "score": pa.array(s, pa.float64())})

    key = ["dim", "block", "query_block"]
    best = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(search, "query_id long, vec_id long, score double")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy("score", "vec_id"))
    best = best.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
