"""Vector tables: which rows take part, and blocks of them in numpy."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY_LIMIT = 1_000_000


def usable(vector: Column) -> Column:
    """Not null, not empty, no null and no non-finite component."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & F.coalesce(finite, F.lit(False))


def usable_rows(df: DataFrame) -> DataFrame:
    """vec_id, embedding (array of double) of the rows that take part."""
    return (df.select("vec_id", "embedding").filter(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
            .select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")))


def query_rows(rows: DataFrame, every: int) -> DataFrame:
    """Rows whose id is divisible by ``every``, one per id (the least vector)."""
    return (rows.filter(F.col("vec_id") % every == 0)
            .groupBy("vec_id").agg(F.min("embedding").alias("embedding")))


def matrix(column: pd.Series, dtype=np.float64) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=dtype) for v in column]) if len(column) else np.empty((0, 0), dtype)


def distinct_rows(ids: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Positions of the first of each set of exact repeats (id and vector)."""
    if len(ids) == len(np.unique(ids)):
        return np.arange(len(ids))
    seen: set = set()
    return np.array([i for i, k in enumerate(zip(ids.tolist(), map(bytes, x)))
                     if not (k in seen or seen.add(k))], np.int64)


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to smaller ids."""
    if len(scores) > 8 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= least)
        return some[np.lexsort((ids[some], -scores[some]))[:k]]
    return np.lexsort((ids, -scores))[:k]
