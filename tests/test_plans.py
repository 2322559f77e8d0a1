"""Plan-level guards: no cross products, pruned scans, bounded broadcasts."""

import re

import pytest

from conftest import SF_SMALL
import __spark_entry__ as entry
from tastemap.sources.interactions import interactions


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# The estimator's own top-n call meets blocks of users and items: the one exception.
BUILT_IN_TOP_N = {"als_top100", "als_implicit_top100", "als_metrics", "als_list_shape", "als_unseen_shape",
                  "als_evaluated_users"}


@pytest.mark.parametrize("name", sorted({*entry.oracle_sql(), *BUILT_IN_TOP_N}))
def test_no_cross_products(spark, name):
    plan = _plan(entry.queries()[name](spark, SF_SMALL))
    if name not in BUILT_IN_TOP_N:
        assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_bucketed_join_needs_no_exchange(spark):
    from tastemap.plans.catalog import q_bucketed_counts
    df = q_bucketed_counts(spark, SF_SMALL)
    df.collect()
    plan = _plan(df)
    assert "SortMergeJoin" in plan and "Exchange" not in plan and plan.count("Bucketed: true") >= 2


def test_interaction_scans_are_pruned(spark):
    plan = interactions(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    widths = sorted(len(s.split(",")) for s in schemas)
    assert widths == [3, 4]  # orders: 3 of 6 columns; lineitem: 4 of 11


def test_lineitem_orders_is_a_shuffle_join(spark):
    plan = _plan(interactions(spark, SF_SMALL))
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_truth_set_is_shuffled_once(spark):
    from pyspark.sql import functions as F
    from tastemap.operators.popularity import PopularityRecommender
    from tastemap.operators.ranking import summarize
    from tastemap.plans.catalog import split_table

    s = split_table(spark, SF_SMALL)
    pop = PopularityRecommender(100).create(s.filter(F.col("split") == "train"))
    df = summarize(pop.evaluate_by_user(s.filter(F.col("split") == "val"), 100))
    df.collect()
    final = _plan(df).split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final and "hashpartitioning(user_id" in final
