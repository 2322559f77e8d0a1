"""Array columns spread over scalar columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def spread_vector(df: DataFrame, vector_col: str, width: int, keep: list[str],
                  prefix: str = "f_") -> DataFrame:
    """``keep`` columns plus ``prefix0 .. prefix{width-1}`` from a fixed-width array.

    Array indexing is a projection, so this stays in the scan's codegen stage.
    """
    return df.select(*keep, *[F.col(vector_col)[i].alias(f"{prefix}{i}") for i in range(width)])
