import glob

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tastemap.operators import tuning
from tastemap.plans import jobs
from tastemap.plans.catalog import q_popularity_metrics, split_rows
from tastemap.session import scratch_path


@pytest.fixture(scope="module")
def splits_path(spark):
    return jobs.write_splits(spark, SF_SMALL, scratch_path(spark, "job-splits"))


def test_written_splits_equal_the_plan(spark, splits_path):
    written = spark.read.parquet(splits_path)
    planned = split_rows(spark, SF_SMALL)
    assert written.exceptAll(planned.select(*written.columns)).count() == 0
    assert planned.select(*written.columns).exceptAll(written).count() == 0
    assert sorted(p.split("=")[-1] for p in glob.glob(splits_path.replace("file:", "") + "/split=*")) == \
        ["test", "train", "val"]


def test_popularity_job_matches_query(spark, splits_path):
    got = jobs.evaluate_popularity(jobs.read_splits(spark, splits_path), 100,
                                   report_path=scratch_path(spark, "pop-report"))
    want = q_popularity_metrics(spark, SF_SMALL)
    assert got.exceptAll(want).count() == 0 and got.count() == 2


def test_als_job_and_export(spark, splits_path):
    out = scratch_path(spark, "als-export")
    metrics = jobs.evaluate_als(jobs.read_splits(spark, splits_path), rank=4, max_iter=3, reg=0.1, k=10,
                                export_dir=out).collect()
    assert [r["split"] for r in metrics] == ["val", "test"]
    assert all(r["rmse"] > 0 and 0 <= r["ndcg_at_k"] <= 1 for r in metrics)
    exported = spark.read.option("header", True).csv(f"{out}/all-users")
    assert exported.columns == ["user_id", "rank", "item_id", "score"]
    per_user = exported.groupBy("user_id").count().agg(F.max("count")).first()[0]
    assert per_user == 10


def test_latent_factor_job(spark, splits_path):
    out = scratch_path(spark, "factors")
    jobs.latent_factors(jobs.read_splits(spark, splits_path), out, rank=3, max_iter=2)
    users = spark.read.option("header", True).csv(f"{out}/user")
    assert users.columns == ["kind", "id", "f_0", "f_1", "f_2"]
    train_users = jobs.read_splits(spark, splits_path)["train"].select("user_id").distinct().count()
    assert users.count() == train_users


def test_sampled_comparison_job(spark, splits_path):
    points = tuning.grid((2, 4), (2,), (0.1,), implicit=True)
    out = jobs.sampled_comparison(spark, splits_path, scratch_path(spark, "sampled"), fraction=0.5,
                                  partitions=4, points=points, k_tune=50, k_test=10)
    assert out["grid"].count() == 2
    best = out["best"].first()
    assert best["precision_at_k"] == max(r["precision_at_k"] for r in out["grid"].collect())
    assert out["refit"].first()["k"] == 10
    assert out["cross_table"].columns == ["reg", "2", "4"]


def test_split_from_a_rating_file(spark, splits_path):
    from tastemap.sources.files import write_csv_parts
    from tastemap.sources.interactions import interactions

    inter = interactions(spark, SF_SMALL)
    csv_path = scratch_path(spark, "ratings-file")
    write_csv_parts(inter.select(F.col("user_id").cast("int").alias("userId"),
                                 F.col("item_id").cast("int").alias("movieId"), "rating",
                                 F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")
                                 .cast("int").alias("timestamp")), csv_path, header=True, mode="overwrite")
    out = jobs.write_splits_from_ratings(spark, csv_path, scratch_path(spark, "csv-splits"))
    per_user = lambda df: {(r["user_id"], r["split"]): r["count"]
                           for r in df.groupBy("user_id", "split").count().collect()}
    assert per_user(spark.read.parquet(out)) == per_user(spark.read.parquet(splits_path))
