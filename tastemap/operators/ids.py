"""Dense ids for columns whose values ALS can't hold (it keeps ids as INT).

``id_table`` numbers a column's distinct values from 0 by their order, without
a single-task window; ``encode`` and ``decode`` are plain joins with it, so
neither ids nor maps pass through the driver and a hot id is split by AQE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastemap.functions.numbering import with_global_index
from tastemap.sources.files import materialize

MOST_IDS = 2 ** 31 - 1


def id_table(rows: DataFrame, column: str) -> DataFrame:
    """(column, dense): a number from 0 for every distinct value that is not null."""
    distinct = materialize(rows.select(column).filter(F.col(column).isNotNull()).distinct(), "ids")
    n = distinct.count()
    if n > MOST_IDS:
        raise ValueError(f"{n} values of {column}: ALS holds at most {MOST_IDS}")
    return materialize(with_global_index(distinct, [column], "dense", expected_rows=n), "id-table")


def encode(rows: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """``rows`` with ``column`` replaced by its number; values without one go."""
    return rows.join(ids, column).drop(column).withColumnRenamed("dense", column).select(*rows.columns)


def decode(rows: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """``rows`` with the numbers in ``column`` replaced by the values."""
    back = ids.select(F.col("dense").alias("_dense"), F.col(column).alias("_value"))
    kept = [F.col("_value").alias(c) if c == column else F.col(c) for c in rows.columns]
    return rows.join(back, F.col(column) == F.col("_dense")).select(*kept)
