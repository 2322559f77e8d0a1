"""Exploded metric plans against pyspark.ml's RankingEvaluator on real lists."""

from pyspark.ml.evaluation import RankingEvaluator
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tastemap.operators import als as als_ops
from tastemap.operators.popularity import PopularityRecommender
from tastemap.operators.ranking import ranking_metrics, summarize
from tastemap.plans.catalog import split_rows


def _evaluator_metrics(recs, truth, k):
    """Test-only array form: lists and truth sets collected per user (tiny data)."""
    lists = (recs.groupBy("user_id")
             .agg(F.sort_array(F.collect_list(F.struct("rank", "item_id"))).alias("l"))
             .select("user_id", F.col("l.item_id").cast("array<double>").alias("prediction")))
    sets = truth.groupBy("user_id").agg(F.collect_set("item_id").cast("array<double>").alias("label"))
    both = lists.join(sets, "user_id")
    out = {}
    for metric, name in (("precisionAtK", "precision_at_k"), ("meanAveragePrecision", "map"),
                         ("ndcgAtK", "ndcg_at_k")):
        out[name] = RankingEvaluator(metricName=metric, k=k).evaluate(both)
    return out


def _close(ours, theirs):
    for name, value in theirs.items():
        assert abs(ours[name] - value) < 1e-8, (name, ours[name], value)


def test_als_lists(spark):
    s = split_rows(spark, SF_SMALL)
    train, val = s.filter("split = 'train'"), s.filter("split = 'val'")
    model = als_ops.fit_als(train, rank=5, max_iter=3, reg=0.1)
    recs = als_ops.recommend(model, 20, val.select("user_id"))
    _close(ranking_metrics(recs, val, 20).first().asDict(), _evaluator_metrics(recs, val, 20))


def test_popularity_shared_list(spark):
    s = split_rows(spark, SF_SMALL)
    train, val = s.filter("split = 'train'"), s.filter("split = 'val'")
    pop = PopularityRecommender(50).create(train)
    shared = summarize(pop.evaluate_by_user(val, 50)).first().asDict()
    recs = pop.recommend(val)
    generic = ranking_metrics(recs, val, 50).first().asDict()
    assert shared == generic
    _close(shared, _evaluator_metrics(recs, val, 50))
