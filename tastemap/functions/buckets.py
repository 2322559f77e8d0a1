"""Repeatable pseudo-random buckets computed from row keys.

``DataFrame.randomSplit`` and ``DataFrame.sample`` draw per partition, so the
outcome moves when the input is partitioned differently.  A bucket derived
from the key itself does not: the same key lands in the same bucket on any
cluster, in any engine.  The first 32 bits of ``md5("seed:key:...")`` are
read as an unsigned integer and taken modulo the bucket count (1000 by
default, so fractions resolve to 0.1 %).  ``hash_bucket_sql`` is the same
expression for DuckDB, so every split and sample has an exact SQL oracle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BUCKETS = 1000            # of the fixed split rule
SAMPLE_BUCKETS = 2 ** 32  # samples use all 32 bits, so tiny fractions are not rounded away


def hash_bucket(cols: list[str | Column], seed: int | str, buckets: int = BUCKETS) -> Column:
    parts = [F.lit(str(seed))] + [F.col(c).cast("string") if isinstance(c, str) else c.cast("string")
                                   for c in cols]
    digest = F.md5(F.concat_ws(":", *parts))
    high32 = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return high32 % F.lit(buckets)


def hash_bucket_sql(cols: list[str], seed: int | str, buckets: int = BUCKETS) -> str:
    """DuckDB text of ``hash_bucket`` (``concat_ws`` skips NULLs in both engines)."""
    args = ", ".join([f"'{seed}'"] + [f"CAST({c} AS VARCHAR)" for c in cols])
    return f"(('0x' || substr(md5(concat_ws(':', {args})), 1, 8))::BIGINT % {buckets})"


def fraction_threshold(fraction: float, buckets: int = BUCKETS) -> int:
    """Buckets below the returned value hold ``fraction`` of the keys."""
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must lie in [0, 1]")
    return int(round(fraction * buckets))


def bucket_thresholds(fractions, buckets: int = BUCKETS) -> list[int]:
    """Upper bucket bounds of consecutive groups taking ``fractions`` (normalized)."""
    total = float(sum(fractions))
    if total <= 0 or any(f < 0 for f in fractions):
        raise ValueError("fractions must be non-negative with a positive sum")
    bounds, acc = [], 0.0
    for f in fractions:
        acc += f / total
        bounds.append(fraction_threshold(min(acc, 1.0), buckets))
    bounds[-1] = buckets
    return bounds
