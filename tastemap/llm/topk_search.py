"""Exact top-k inner-product search by the threshold algorithm (Fagin).

Vectors are dealt into blocks by a hash of their id, queries into query
blocks; each (vector block, query block) tile is one bounded group.  A tile
sorts every dimension once.  A query walks the lists of its non-zero
components from their better end (descending for a positive weight, ascending
for a negative one) in rounds of growing depth, scores each vector the first
time any list shows it, and stops when the bound on unseen vectors (the sum of
weight times the last value seen, over the lists) is below its k-th best
score.  On equality it goes on, since an unseen vector of a smaller id could
tie.  The tiles' k best are merged per query.

Edge cases: vectors null, empty, or holding null or non-finite components take
no part; vectors of different length are never compared; exact repeats of a
row count once; rows with the query's id are no candidates; ties go to the
smaller id; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tastemap.llm.vectors import best, distinct_rows, matrix, query_rows, usable_rows

BLOCK_ROWS = 8192      # vectors of a tile, about
QUERY_BLOCK = 1024     # queries of a tile, about
FIRST_DEPTH = 32


def threshold_search(x: np.ndarray, ids: np.ndarray, lists: np.ndarray, q: np.ndarray, own: int,
                     k: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, scores) of the k best rows of ``x`` for ``q``.  ``lists``: row
    numbers by ascending value, a column for each dimension."""
    n = len(x)
    up, down = np.flatnonzero(q < 0), np.flatnonzero(q > 0)
    seen = ids == own
    top_ids, top = np.empty(0, np.int64), np.empty(0, x.dtype)
    if not len(up) and not len(down):
        rest = np.flatnonzero(~seen)
        at = rest[np.argsort(ids[rest], kind="stable")[:k]]
        return ids[at], np.zeros(len(at), x.dtype)
    depth, step = 0, FIRST_DEPTH
    while depth < n:
        upto = min(n, depth + step)
        shown = np.concatenate([lists[depth:upto, up].ravel(), lists[n - upto:n - depth, down].ravel()])
        fresh = np.zeros(n, bool)
        fresh[shown] = True
        fresh &= ~seen
        seen |= fresh
        at = np.flatnonzero(fresh)
        top_ids, top = np.concatenate([top_ids, ids[at]]), np.concatenate([top, x[at] @ q])
        keep = best(top_ids, top, k)
        top_ids, top = top_ids[keep], top[keep]
        bound = (q[up] * x[lists[upto - 1, up], up]).sum() + (q[down] * x[lists[n - upto, down], down]).sum()
        if len(top) == k and bound < top[-1]:
            break
        depth, step = upto, 2 * step
    return top_ids, top


def _search_tile(key, vectors: pd.DataFrame, queries: pd.DataFrame, k: int) -> pd.DataFrame:
    out = []
    if len(vectors) and len(queries):
        x, ids = matrix(vectors["v"], np.int64), vectors["vec_id"].to_numpy()
        keep = distinct_rows(ids, x)
        x, ids, q = x[keep], ids[keep], matrix(queries["v"], np.int64)
        if int(np.abs(x).max()) * int(np.abs(q).max()) * x.shape[1] < 2**53:
            x, q = x.astype(np.float64), q.astype(np.float64)    # exact, and faster
        lists = np.argsort(x, axis=0, kind="stable")
        for own, row in zip(queries["vec_id"].to_numpy(), q):
            found, scores = threshold_search(x, ids, lists, row, own, k)
            out.append(pd.DataFrame({"query_id": own, "vec_id": found, "score": scores.astype(np.int64)}))
    return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")


def top_k(df: DataFrame, k: int = 10, every: int = 100, scale: int = 1024, block_rows: int = BLOCK_ROWS,
          query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score over vec_id, embedding."""
    rows = usable_rows(df).select(
        "vec_id", F.transform("embedding", lambda x: F.floor(x * scale).cast("long")).alias("v"),
        F.size("embedding").alias("dim"))
    queries = (rows.filter(F.col("vec_id") % every == 0)
               .groupBy("vec_id", "dim").agg(F.min("v").alias("v")))
    n = df.count()
    blocks, q_blocks = -(-n // block_rows) or 1, -(-n // (every * query_block)) or 1

    def dealt(name, into):
        return F.pmod(F.xxhash64("vec_id"), F.lit(into)).cast("int").alias(name)

    left = rows.select("vec_id", "v", "dim", dealt("block", blocks),
                       F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))).alias("q_block"))
    right = queries.select("vec_id", "v", "dim", dealt("q_block", q_blocks),
                           F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    by = ["dim", "block", "q_block"]

    def search(key, vectors, wanted):
        return _search_tile(key, vectors, wanted, k)

    found = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInPandas(
        search, "query_id long, vec_id long, score long")
    best_first = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best_first)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
