"""Popularity baseline: the n items most users interacted with, for everyone."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tastemap.operators.ranking import shared_list_metrics_by_user


def popularity_scores(train: DataFrame, item: str = "item_id", user: str = "user_id") -> DataFrame:
    """(item, score): non-null user count per item; partial counts per task
    keep a hot item to one row per task before the shuffle."""
    return train.groupBy(item).agg(F.count(user).cast("long").alias("score"))


def top_items(scores: DataFrame, n: int = 100, item: str = "item_id") -> DataFrame:
    """(item, score, rank) for the n best items, score descending, item ascending.

    ``orderBy().limit(n)`` plans as a per-task top-n plus a merge of n rows per
    task; the rank is numbered on those n rows only.
    """
    best = scores.orderBy(F.desc("score"), F.asc(item)).limit(n)
    order = Window.orderBy(F.desc("score"), F.asc(item))
    return best.withColumn("rank", F.row_number().over(order).cast("long"))


def top_items_array(top: DataFrame, item: str = "item_id") -> DataFrame:
    """One row, one column: the ranked list as an array of (rank, item, score)."""
    return top.select(F.sort_array(F.collect_list(F.struct("rank", item, "score"))).alias("recs"))


def recommend_popular(users: DataFrame, top: DataFrame, user: str = "user_id",
                      item: str = "item_id") -> DataFrame:
    """(user, item, score, rank): the same top list for every user.

    The list (≤ n entries) enters as a scalar subquery evaluated once, and
    each user row is expanded with ``inline`` — no join, no shuffle of users.
    """
    recs = top_items_array(top, item).scalar()
    return users.select(user, F.inline(recs)).select(user, item, "score", "rank")


class PopularityRecommender:
    """``create(train)`` then ``recommend(users)``, for any number of users."""

    def __init__(self, n: int = 100, user: str = "user_id", item: str = "item_id"):
        self.n, self.user, self.item = n, user, item
        self.top: DataFrame | None = None

    def create(self, train: DataFrame) -> "PopularityRecommender":
        self.top = top_items(popularity_scores(train, self.item, self.user), self.n, self.item)
        return self

    def recommend(self, users: DataFrame) -> DataFrame:
        if self.top is None:
            raise RuntimeError("call create() first")
        return recommend_popular(users.select(self.user).distinct(), self.top, self.user, self.item)

    def evaluate_by_user(self, truth: DataFrame, k: int | None = None) -> DataFrame:
        """Per-user precision@k, AP and NDCG@k of the list for the users of ``truth``."""
        if self.top is None:
            raise RuntimeError("call create() first")
        return shared_list_metrics_by_user(self.top, truth, k or self.n, self.user, self.item)
