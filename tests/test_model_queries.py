"""Registered queries without a SQL twin: they run and have the right shape."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
import __spark_entry__ as entry
from tastemap.plans.catalog import QUERIES

# Of the library itself, whether or not the llm package is there.
MODEL_QUERIES = sorted(set(QUERIES) - set(entry.oracle_sql()))


def test_model_queries_listed():
    assert MODEL_QUERIES == sorted([
        "als_predictions", "als_top100", "als_metrics", "als_implicit_top100", "als_factors", "als_grid",
        "implicit_grid", "best_params", "best_implicit_params", "best_refit", "metric_cross_table"])


@pytest.mark.parametrize("name", MODEL_QUERIES)
def test_model_query_shape(spark, name):
    df = entry.queries()[name](spark, SF_SMALL)
    rows = df.count()
    assert rows > 0
    if name in ("als_top100", "als_implicit_top100"):
        per_user = df.groupBy("user_id").agg(F.count("*").alias("n"), F.min("rank").alias("lo"),
                                             F.max("rank").alias("hi"))
        stats = per_user.agg(F.max("n"), F.min("lo"), F.max("hi")).first()
        assert stats[0] <= 100 and stats[1] == 1 and stats[2] == stats[0]
    if name == "als_factors":
        assert df.columns[:3] == ["kind", "id", "f_0"] and len(df.columns) == 2 + 20
    if name in ("best_params", "best_implicit_params", "best_refit"):
        assert rows == 1
    if name == "als_metrics":
        assert sorted(r["split"] for r in df.collect()) == ["test", "val"]
