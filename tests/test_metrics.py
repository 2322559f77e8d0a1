import random

import pytest
from pyspark.ml.evaluation import RankingEvaluator

from tastemap.operators.ranking import explode_lists, ranking_metrics, ranking_metrics_by_user, rmse

# Hand cases (list, truth) with known results.
CASES = [([1, 2, 3, 4, 5], [2, 5, 9]), ([7, 8], [8, 8, 1, 2]), ([1, 2, 3], [9]), ([5, 4, 3, 2, 1], [])]


def _frames(spark, cases):
    lists = spark.createDataFrame([(u, [float(x) for x in p], [float(x) for x in t])
                                   for u, (p, t) in enumerate(cases)],
                                  "user_id LONG, prediction ARRAY<DOUBLE>, label ARRAY<DOUBLE>")
    recs = spark.createDataFrame([(u, r + 1, x) for u, (p, _) in enumerate(cases) for r, x in enumerate(p)],
                                 "user_id LONG, rank LONG, item_id LONG")
    truth = spark.createDataFrame([(u, x) for u, (_, t) in enumerate(cases) for x in t],
                                  "user_id LONG, item_id LONG")
    return lists, recs, truth


def _evaluator(lists, metric, k):
    ev = RankingEvaluator(predictionCol="prediction", labelCol="label", metricName=metric, k=k)
    return ev.evaluate(lists)


@pytest.mark.parametrize("k,precision,ndcg", [(3, 0.1666666667, 0.1480409555), (10, 0.075, 0.1934264036)])
def test_hand_cases(spark, k, precision, ndcg):
    lists, recs, truth = _frames(spark, CASES)
    # The empty-truth user has no truth rows, so it leaves the join; score the
    # three others like the evaluator does with four (the 4th contributes 0).
    per_user = ranking_metrics_by_user(recs, truth, k).toPandas()
    assert len(per_user) == 3
    assert abs(per_user.precision_at_k.sum() / 4 - precision) < 1e-9
    assert abs(per_user.ndcg_at_k.sum() / 4 - ndcg) < 1e-9
    assert abs(per_user.average_precision.sum() / 4 - 0.1166666667) < 1e-9
    assert abs(_evaluator(lists, "precisionAtK", k) - precision) < 1e-9
    assert abs(_evaluator(lists, "ndcgAtK", k) - ndcg) < 1e-9
    assert abs(_evaluator(lists, "meanAveragePrecision", k) - 0.1166666667) < 1e-9


def test_random_lists_match_ranking_evaluator(spark):
    rng = random.Random(7)
    cases = []
    for _ in range(60):
        pred = rng.sample(range(40), rng.randint(1, 15))
        truth = [rng.randrange(40) for _ in range(rng.randint(1, 12))]
        cases.append((pred, truth))
    lists, recs, truth = _frames(spark, cases)
    for k in (1, 5, 10, 20):
        got = ranking_metrics(recs, truth, k).first()
        assert got["n_users"] == len(cases)
        assert abs(got["precision_at_k"] - _evaluator(lists, "precisionAtK", k)) < 1e-9
        assert abs(got["ndcg_at_k"] - _evaluator(lists, "ndcgAtK", k)) < 1e-9
        assert abs(got["map"] - _evaluator(lists, "meanAveragePrecision", k)) < 1e-9


def test_explode_lists_keeps_rank(spark):
    df = spark.createDataFrame([(1, [(10, 0.9), (11, 0.5)])],
                               "user_id INT, recommendations ARRAY<STRUCT<item_id: INT, rating: FLOAT>>")
    rows = explode_lists(df, "user_id", "recommendations", "item_id", "rating").collect()
    assert [(r["rank"], r["item_id"]) for r in rows] == [(1, 10), (2, 11)]


def test_rmse(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0)], "rating DOUBLE, prediction DOUBLE")
    assert abs(rmse(df).first()["rmse"] - (0.5 ** 0.5)) < 1e-9
