import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL
from tastemap.functions.buckets import hash_bucket, hash_bucket_sql
from tastemap.functions.numbering import with_global_index
from tastemap.operators.prep import active_users, hash_sample, nonzero_ratings
from tastemap.operators.split import interaction_split, train_val_test, user_groups
from tastemap.sources.interactions import interactions


@pytest.fixture(scope="module")
def split_pdf(spark):
    return train_val_test(interactions(spark, SF_MID)).toPandas()


def test_hash_bucket_equal_in_spark_and_duckdb(spark):
    ids = spark.range(0, 3000).withColumnRenamed("id", "user_id")
    got = ids.select("user_id", hash_bucket(["user_id"], 2020).alias("b")).toPandas().sort_values("user_id")
    con = duckdb.connect()
    want = con.sql(f"SELECT range AS user_id, {hash_bucket_sql(['range'], 2020)} AS b FROM range(3000)").df()
    assert (got["b"].values == want.sort_values("user_id")["b"].values).all()
    assert 0 <= got["b"].min() and got["b"].max() < 1000


def test_user_groups_fractions(spark):
    users = active_users(nonzero_ratings(interactions(spark, SF_MID))).select("user_id")
    counts = {r["grp"]: r["count"] for r in user_groups(users).groupBy("grp").count().collect()}
    total = sum(counts.values())
    assert abs(counts["train"] / total - 0.6) < 0.05
    assert abs(counts["val"] / total - 0.2) < 0.05


def test_split_properties(spark, split_pdf):
    pdf = split_pdf
    users = {name: set(pdf[pdf.split == name].user_id) for name in ("train", "val", "test")}
    assert not users["val"] & users["test"]
    assert users["val"] <= users["train"] and users["test"] <= users["train"]
    # union of splits = nonzero rows of users with >= 10 of them
    rated = nonzero_ratings(interactions(spark, SF_MID))
    kept = rated.join(active_users(rated), "user_id", "left_semi").count()
    assert len(pdf) == kept
    # each held-out user keeps floor or ceil of half of its rows for evaluation
    for name in ("val", "test"):
        held_users = users[name]
        per_user = pdf[pdf.user_id.isin(held_users)].groupby("user_id").split.agg(
            lambda s: (s == name).sum() - (s == "train").sum())
        assert per_user.abs().max() <= 1


def test_split_ignores_layout(spark, split_pdf):
    shuffled = interactions(spark, SF_MID).repartition(13, "item_id")
    again = train_val_test(shuffled).toPandas()
    key = ["user_id", "item_id", "ts", "ok", "ln", "rating", "split"]
    a = split_pdf[key].sort_values(key).reset_index(drop=True)
    b = again[key].sort_values(key).reset_index(drop=True)
    assert a.equals(b)


def test_global_index_is_exact_under_a_hot_key(spark):
    # one key holds a third of the rows
    n = 30000
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"),
                               (F.col("id") * 7919 % 10007).alias("v"))
    out = with_global_index(df, ["k", "v"], "ix", num_partitions=12)
    pdf = out.toPandas().sort_values("ix").reset_index(drop=True)
    assert list(pdf["ix"]) == list(range(n))
    expect = pdf.sort_values(["k", "v"]).reset_index(drop=True)
    assert (expect[["k", "v"]].values == pdf[["k", "v"]].values).all()
    # the hot key is spread over several partitions
    parts = (df.repartitionByRange(12, "k", "v").filter("k = 7")
             .select(F.spark_partition_id().alias("p")).distinct().count())
    assert parts >= 3


def test_hash_sample_is_stable(spark):
    rows = nonzero_ratings(interactions(spark, SF_SMALL))
    a = hash_sample(rows, 0.125, 2020, ["user_id", "item_id", "ok", "ln"])
    b = hash_sample(rows.repartition(5), 0.125, 2020, ["user_id", "item_id", "ok", "ln"])
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    frac = a.count() / rows.count()
    assert 0.09 < frac < 0.16


def test_interaction_split_fractions(spark):
    pairs = nonzero_ratings(interactions(spark, SF_MID)).select("user_id", "item_id").distinct()
    counts = {r["split"]: r["count"] for r in interaction_split(pairs).groupBy("split").count().collect()}
    total = sum(counts.values())
    assert abs(counts["train"] / total - 0.2) < 0.02
    assert abs(counts["val"] / total - 0.4) < 0.02


def test_running_sum_matches_brute_force(spark):
    from tastemap.functions.numbering import with_running_sum

    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("k"), (F.col("id") % 13 + 1).alias("w"))
    got = with_running_sum(df, ["k"], "w", "before", num_partitions=7).toPandas().sort_values("k")
    want = got["w"].cumsum() - got["w"]
    assert (got["before"].values == want.values).all()
