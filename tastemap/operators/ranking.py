"""Ground truth, ranking metrics and RMSE, computed on exploded rows.

Ranked lists are rows ``(user, rank, item)`` (rank from 1) and the truth is
rows ``(user, item)``.  Lists are joined to the truth on the pair
``(user, item)``, so a user with a huge history is spread over many tasks;
only the hits (at most list-length per user) and one size per user are
grouped by user.  No truth list is ever collected into an array.

Definitions (binary relevance, truth T as a set, p_i the item at rank i),
equal to ``pyspark.ml.evaluation.RankingEvaluator``:

* precision@k = |{i ≤ k : p_i ∈ T}| / k
* AP          = Σ_{i : p_i ∈ T} (hits among ranks ≤ i) / i, divided by |T|
* NDCG@k      = Σ_{i ≤ k, p_i ∈ T} 1/ln(i+1)  ÷  Σ_{i ≤ min(|T|, k)} 1/ln(i+1)

Means run over the users that have both a list and a non-empty truth set.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


METRIC_DIGITS = 10


def truth_sets(rows: DataFrame, user: str = "user_id", item: str = "item_id") -> DataFrame:
    """Distinct (user, item): the truth as a set, one row per element.

    NULL keys are dropped here, where the hit join would drop them anyway, so
    the sizes branch and the hits branch share one plan and one shuffle.
    """
    return rows.select(user, item).filter(F.col(user).isNotNull() & F.col(item).isNotNull()).distinct()


def truth_sizes(truth: DataFrame, user: str = "user_id") -> DataFrame:
    return truth.groupBy(user).agg(F.count(F.lit(1)).alias("n_truth"))


def explode_lists(lists: DataFrame, user: str, array_col: str, item_field: str,
                  score_field: str | None = None, item: str = "item_id") -> DataFrame:
    """Array-of-struct lists → (user, rank, item[, score]), rank from 1."""
    exploded = lists.select(user, F.posexplode(array_col).alias("pos", "entry"))
    cols = [F.col(user), (F.col("pos") + 1).cast("long").alias("rank"),
            F.col(f"entry.{item_field}").cast("long").alias(item)]
    if score_field:
        cols.append(F.col(f"entry.{score_field}").alias("score"))
    return exploded.select(*cols)


def _ideal_dcg(n_truth, k: int):
    upto = F.least(n_truth, F.lit(k))
    return F.aggregate(F.sequence(F.lit(1), upto.cast("int")), F.lit(0.0),
                       lambda acc, i: acc + F.lit(1.0) / F.log(i + F.lit(1.0)))


def per_user_metrics(listed_sizes: DataFrame, hits: DataFrame, k: int, user: str, rank: str) -> DataFrame:
    """Metrics from the evaluated users (user, n_truth) and their hits (user, rank)."""
    in_order = Window.partitionBy(user).orderBy(rank)
    hit_stats = (hits.withColumn("hit_no", F.row_number().over(in_order))
                 .groupBy(user)
                 .agg(F.sum(F.when(F.col(rank) <= k, 1).otherwise(0)).cast("long").alias("hits_at_k"),
                      F.count(F.lit(1)).alias("n_hits"),
                      F.sum(F.col("hit_no") / F.col(rank)).alias("ap_sum"),
                      F.sum(F.when(F.col(rank) <= k, F.lit(1.0) / F.log(F.col(rank) + F.lit(1.0)))
                            .otherwise(F.lit(0.0))).alias("dcg")))
    users = listed_sizes.join(hit_stats, user, "left").na.fill(0, ["hits_at_k", "n_hits"])
    return users.select(
        user, "n_truth", "n_hits",
        (F.col("hits_at_k") / F.lit(float(k))).alias("precision_at_k"),
        (F.coalesce(F.col("ap_sum"), F.lit(0.0)) / F.col("n_truth")).alias("average_precision"),
        (F.coalesce(F.col("dcg"), F.lit(0.0)) / _ideal_dcg(F.col("n_truth"), k)).alias("ndcg_at_k"),
    )


def ranking_metrics_by_user(recs: DataFrame, truth: DataFrame, k: int, user: str = "user_id",
                            item: str = "item_id", rank: str = "rank") -> DataFrame:
    """(user, n_truth, n_hits, precision_at_k, average_precision, ndcg_at_k).

    ``recs`` holds one ranked list per user.  Hits come from a join on the
    pair (user, item): a user with a huge truth set is spread by item.
    """
    truth = truth_sets(truth, user, item)
    listed = recs.select(user).distinct()
    hits = recs.select(user, item, rank).join(truth, [user, item])
    return per_user_metrics(listed.join(truth_sizes(truth, user), user), hits, k, user, rank)


def shared_list_metrics_by_user(top: DataFrame, truth: DataFrame, k: int, user: str = "user_id",
                                item: str = "item_id", rank: str = "rank") -> DataFrame:
    """Same metrics when every user of ``truth`` gets the one list ``top``.

    The list is bounded by its length, so it is broadcast and the hits are
    found per truth row — the users × list rows are never formed.  Equal to
    ``ranking_metrics_by_user(recommend_popular(users of truth, top), truth, k)``.
    """
    truth = truth_sets(truth, user, item)
    hits = truth.join(F.broadcast(top.select(item, rank)), item).select(user, rank)
    return per_user_metrics(truth_sizes(truth, user), hits, k, user, rank)


def summarize(per_user: DataFrame, digits: int = METRIC_DIGITS) -> DataFrame:
    """One row: n_users and the means of the per-user metrics."""
    return per_user.agg(
        F.count(F.lit(1)).alias("n_users"),
        F.round(F.avg("precision_at_k"), digits).alias("precision_at_k"),
        F.round(F.avg("average_precision"), digits).alias("map"),
        F.round(F.avg("ndcg_at_k"), digits).alias("ndcg_at_k"),
    )


def ranking_metrics(recs: DataFrame, truth: DataFrame, k: int, user: str = "user_id",
                    item: str = "item_id", rank: str = "rank", digits: int = METRIC_DIGITS) -> DataFrame:
    """One row: n_users, precision_at_k, map, ndcg_at_k (means over users)."""
    return summarize(ranking_metrics_by_user(recs, truth, k, user, item, rank), digits)


def rmse(predictions: DataFrame, label: str = "rating", prediction: str = "prediction",
         digits: int = METRIC_DIGITS) -> DataFrame:
    """One row: n_rows, rmse — a global aggregate with partial sums per task."""
    err = F.col(label).cast("double") - F.col(prediction).cast("double")
    return predictions.agg(F.count(F.lit(1)).alias("n_rows"),
                           F.round(F.sqrt(F.avg(err * err)), digits).alias("rmse"))


def item_mean_predictions(train: DataFrame, target: DataFrame, item: str = "item_id",
                          rating: str = "rating") -> DataFrame:
    """Target rows scored with the item's mean training rating; items unseen in
    training are dropped, like ALS with the ``drop`` cold-start strategy.

    The engine picks the join from the sides' real sizes and splits a hot item.
    """
    means = train.groupBy(item).agg(F.avg(rating).alias("prediction"))
    return target.join(means, item)
