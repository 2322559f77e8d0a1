import csv
import glob

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tastemap.operators.popularity import PopularityRecommender, popularity_scores, top_items
from tastemap.session import scratch_path
from tastemap.sources.files import read_csv_table, write_single_csv


def test_tie_rule_and_rank(spark):
    train = spark.createDataFrame([(u, i) for i, n in [(5, 3), (3, 3), (9, 2), (1, 1)] for u in range(n)],
                                  "user_id LONG, item_id LONG")
    top = top_items(popularity_scores(train), 3).orderBy("rank").collect()
    assert [(r["item_id"], r["score"], r["rank"]) for r in top] == [(3, 3, 1), (5, 3, 2), (9, 2, 3)]


def test_every_user_gets_the_list(spark):
    train = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").select(
        F.col("l_orderkey").alias("user_id"), F.col("l_partkey").alias("item_id"))
    pr = PopularityRecommender(10).create(train)
    users = train.select("user_id").distinct()
    recs = pr.recommend(users)
    assert recs.count() == users.count() * 10
    per_user = recs.groupBy("user_id").agg(F.collect_list("rank").alias("r")).collect()
    assert all(sorted(r["r"]) == list(range(1, 11)) for r in per_user)


def test_report_csv_format(spark):
    train = spark.createDataFrame([(u, i) for i in range(5) for u in range(i + 1)], "user_id LONG, item_id LONG")
    top = PopularityRecommender(3).create(train).top
    path = scratch_path(spark, "report")
    write_single_csv(top.select("item_id", "score", "rank"), path)
    files = glob.glob(path.replace("file:", "") + "/part-*.csv")
    assert len(files) == 1
    with open(files[0]) as fh:
        rows = list(csv.reader(fh))
    assert rows[0] == ["item_id", "score", "rank"] and len(rows) == 4
    back = read_csv_table(spark, path, "item_id LONG, score LONG, rank LONG").orderBy("rank").collect()
    assert [r["item_id"] for r in back] == [4, 3, 2]


def test_csv_without_header_option_gives_null_row(spark):
    df = spark.createDataFrame([(1, 2, 3.5, 100)], "userId INT, movieId INT, rating DOUBLE, timestamp INT")
    path = scratch_path(spark, "hdr")
    df.coalesce(1).write.option("header", True).csv(path)
    raw = read_csv_table(spark, path, header=False)
    assert raw.count() == 2 and raw.filter("rating != 0").count() == 1
