
from pyspark.sql import functions as F

from conftest import SF_MID
from tastemap.plans.catalog import q_popularity_metrics, split_rows


def test_split_sizes(spark):
    s = split_rows(spark, SF_MID)
    counts = {r["split"]: (r["n"], r["u"]) for r in
              s.groupBy("split").agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("u")).collect()}
    assert sum(n for n, _ in counts.values()) == 56968  # every non-zero row of the 1,487 active users
    assert counts["train"] == (45555, 1487)
    assert counts["test"] == (5335, 293)


def test_popularity_on_validation(spark):
    val = [r for r in q_popularity_metrics(spark, SF_MID).collect() if r["split"] == "val"][0]
    assert (val["precision_at_k"], val["map"], val["ndcg_at_k"]) == (0.0091167192, 0.0027671161, 0.0275165581)
