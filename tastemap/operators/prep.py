"""Cleaning, activity filters and samples (no shuffle except the user count)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastemap.functions.buckets import SAMPLE_BUCKETS, fraction_threshold, hash_bucket
from tastemap.params import MIN_USER_ROWS


def nonzero_ratings(df: DataFrame, rating: str = "rating") -> DataFrame:
    """Rows with a rating other than 0; a NULL rating fails the test too."""
    return df.filter(F.col(rating) != 0)


def drop_null_rows(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    return df.na.drop(how="any", subset=subset)


def copy_column(df: DataFrame, source: str, target: str) -> DataFrame:
    return df.withColumn(target, F.col(source))


def bernoulli_sample(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    """Spark's own per-partition sample: cheap, but it moves with the layout."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def hash_sample(df: DataFrame, fraction: float, seed: int, key_cols: list[str]) -> DataFrame:
    """Keep a row when the hash of its key falls below ``fraction``.

    Same rows on any partitioning and in any engine; a narrow filter, no shuffle.
    """
    return df.filter(hash_bucket(key_cols, seed, SAMPLE_BUCKETS) < F.lit(fraction_threshold(fraction, SAMPLE_BUCKETS)))


def user_activity(df: DataFrame, user: str = "user_id") -> DataFrame:
    """(user, n_rows); partial counts per task before the shuffle, so a user
    holding a third of all rows still sends one row per task."""
    return df.groupBy(user).agg(F.count(F.lit(1)).alias("n_rows"))


def active_users(df: DataFrame, user: str = "user_id", min_rows: int = MIN_USER_ROWS) -> DataFrame:
    """Users with at least ``min_rows`` rows (GROUP BY … HAVING count(*) >= n)."""
    return user_activity(df, user).filter(F.col("n_rows") >= min_rows)


def distinct_users(df: DataFrame, user: str = "user_id") -> DataFrame:
    return df.select(user).distinct()
