"""Train / validation / test splits that repeat on any cluster.

User split: each active user falls into train, validation or test by the
md5 bucket of its id.  Validation and test users then give every other row,
in (time, item, order, line, rating) order within the user, back to
training, starting with the first: each held-out user keeps ⌊n/2⌋ rows for
evaluation.

Numbering is skew-safe: held-out rows get one global index in (user, …)
order (``with_global_index``), and each user's first index is the prefix sum
of the row counts of the held-out users before it, computed on the small
per-user table (``with_running_sum``) and carried by the label join.  The
position within the user is the difference — no window over a user's rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastemap.functions.buckets import bucket_thresholds, hash_bucket
from tastemap.functions.numbering import with_global_index, with_running_sum
from tastemap.operators.prep import active_users, nonzero_ratings
from tastemap.params import MIN_USER_ROWS, PAIR_FRACTIONS, SPLIT_SEED, USER_FRACTIONS
from tastemap.session import hold


SPLIT_NAMES = ("train", "val", "test")


def bucket_label(bucket: Column, fractions, names) -> Column:
    """Name of the group whose bucket range holds ``bucket``."""
    bounds = bucket_thresholds(fractions)
    expr = None
    for bound, name in zip(bounds[:-1], names[:-1]):
        test = bucket < F.lit(bound)
        expr = F.when(test, name) if expr is None else expr.when(test, name)
    return expr.otherwise(names[-1]) if expr is not None else F.lit(names[-1])


def user_groups(users: DataFrame, user: str = "user_id", fractions=USER_FRACTIONS,
                seed: int = SPLIT_SEED, names=SPLIT_NAMES) -> DataFrame:
    """(user, grp): one row per user, labelled by the hash of its id."""
    return users.select(user, bucket_label(hash_bucket([user], seed), fractions, names).alias("grp"))


def order_columns(user: str, item: str, rating: str, ts: str, extra: list[str]) -> list[str]:
    return [user, ts, item, *extra, rating]


def number_held_out(held: DataFrame, order: list[str], expected_rows: int | None = None) -> DataFrame:
    """Global 0-based row index over the held-out rows (skew-safe numbering)."""
    return with_global_index(held, order, "row_index", expected_rows=expected_rows)


def first_positions(stats: DataFrame, user: str = "user_id", expected_users: int | None = None) -> DataFrame:
    """(user, grp, first_index): where each held-out user's rows start in the
    global (user, …) order of held-out rows; NULL for training users."""
    held = stats.filter(F.col("grp") != "train").select(user, "n_rows")
    starts = with_running_sum(held, [user], "n_rows", "first_index", expected_rows=expected_users)
    return stats.select(user, "grp").join(starts.select(user, "first_index"), user, "left")


def user_table_sizes(stats: DataFrame) -> tuple[int, int]:
    """(active users, rows of validation and test users) in one pass over the user table."""
    row = stats.agg(F.count(F.lit(1)).alias("users"),
                    F.sum(F.when(F.col("grp") != "train", F.col("n_rows"))).alias("held")).first()
    return int(row["users"]), int(row["held"] or 0)


def labelled_users(rated: DataFrame, user: str, min_rows: int, fractions, seed: int) -> DataFrame:
    """(user, n_rows, grp) for active users, persisted: the size check, the
    held-out row count and the join all read this one small table."""
    stats = active_users(rated, user, min_rows)
    return hold(stats.withColumn("grp", bucket_label(hash_bucket([user], seed), fractions, SPLIT_NAMES)))


def label_and_number(df: DataFrame, user: str = "user_id", item: str = "item_id",
                     rating: str = "rating", ts: str = "ts", extra_order: tuple[str, ...] = ("ok", "ln"),
                     min_rows: int = MIN_USER_ROWS, fractions=USER_FRACTIONS,
                     seed: int = SPLIT_SEED) -> tuple[DataFrame, DataFrame]:
    """(train-group rows, held-out rows with ``row_index`` and ``user_row``), both with ``grp``.

    Drops zero ratings, counts rows per user, labels active users, joins the
    labels and numbers
    the rows of validation and test users in one global order.
    """
    rated = nonzero_ratings(df, rating)
    stats = labelled_users(rated, user, min_rows, fractions, seed)
    n_users, n_held = user_table_sizes(stats)
    # The group is a function of the id alone, so the rows are parted before
    # the joins and each of them is shuffled once at most.
    bucket, bound = hash_bucket([user], seed), bucket_thresholds(fractions)[0]
    train_users = stats.filter(F.col("grp") == "train").select(user)
    train_rows = rated.filter(bucket < bound).join(train_users, user, "left_semi").withColumn("grp", F.lit("train"))
    held = rated.filter(bucket >= bound).join(first_positions(stats, user, n_users), user)
    numbered = number_held_out(held, order_columns(user, item, rating, ts, list(extra_order)), n_held)
    return train_rows, (numbered.withColumn("user_row", F.col("row_index") - F.col("first_index"))
                        .drop("first_index"))


def half_split(numbered: DataFrame) -> DataFrame:
    """Rows at even positions within their user go to training, odd ones stay
    in the user's group."""
    return numbered.withColumn(
        "split", F.when(F.col("user_row") % 2 == 0, F.lit("train")).otherwise(F.col("grp"))
    ).drop("row_index", "user_row")


def train_val_test(df: DataFrame, user: str = "user_id", item: str = "item_id",
                   rating: str = "rating", ts: str = "ts", extra_order: tuple[str, ...] = ("ok", "ln"),
                   min_rows: int = MIN_USER_ROWS, fractions=USER_FRACTIONS, seed: int = SPLIT_SEED) -> DataFrame:
    """All kept rows with a ``split`` column (train / val / test)."""
    train_rows, numbered = label_and_number(df, user, item, rating, ts, extra_order, min_rows, fractions, seed)
    return train_rows.withColumn("split", F.lit("train")).unionByName(half_split(numbered)).drop("grp")


def interaction_split(pairs: DataFrame, user: str = "user_id", item: str = "item_id",
                      fractions=PAIR_FRACTIONS, seed: int = SPLIT_SEED, names=SPLIT_NAMES) -> DataFrame:
    """Split (user, item) entries, not users: 20 / 40 / 40 by the pair hash."""
    return pairs.withColumn("split", bucket_label(hash_bucket([user, item], seed), fractions, names))
