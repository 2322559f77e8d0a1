"""The stored row form of the user-item matrix, bucketed tables, schemas of files."""

import pytest
from pyspark.sql import functions as F

from tastemap.operators.matrix import from_sparse_rows, mean_ratings, sparse_rows
from tastemap.session import scratch_path
from tastemap.sources.files import table_schemas, write_bucketed

KIND = "user_id LONG, item_id LONG, rating DOUBLE"


def test_rows_are_bounded_and_whole(spark):
    rows = [(1, i, float(i % 5)) for i in range(1000)] + [(2, 3, 1.0), (2, 3, 2.0), (None, 4, 5.0), (3, None, 1.0), (4, 5, None)]
    df = spark.createDataFrame(rows, KIND)
    stored = sparse_rows(df, most=100)
    sizes = {(r["user_id"], r["chunk"]): len(r["entries"]) for r in stored.collect()}
    assert sum(u == 1 for u, _ in sizes) == 10 and max(sizes.values()) < 200 and (None, 0) in sizes
    got = sorted(map(tuple, from_sparse_rows(stored).collect()), key=str)
    assert got == sorted(map(tuple, mean_ratings(df).filter("item_id is not null").collect()), key=str)
    assert sparse_rows(spark.createDataFrame([], KIND)).count() == 0


def test_bucketed_table(spark):
    df = spark.createDataFrame([(i % 50, i, 1.0) for i in range(500)], KIND)
    t = write_bucketed(df, "test_bucketed", scratch_path(spark, "bucketed"), "user_id", 4, ["user_id", "item_id"])
    assert t.count() == 500 and t.select(F.input_file_name()).distinct().count() <= 4
    again = write_bucketed(df.limit(10), "test_bucketed", scratch_path(spark, "bucketed"), "user_id", 4)
    assert again.count() == 10
    spark.sql("DROP TABLE test_bucketed")


def test_schemas_of_all_files(spark):
    path = scratch_path(spark, "schemas")
    spark.createDataFrame([(1, "x")], "a INT, b STRING").write.parquet(path)
    spark.createDataFrame([(2, 2.0)], "a INT, c DOUBLE").write.mode("append").parquet(path)
    got = {(r["column"], r["type"]) for r in table_schemas(spark, {"t": path}).collect()}
    assert got == {("a", "int"), ("b", "string"), ("c", "double")}          # columns of either file
    spark.createDataFrame([("s",)], "a STRING").write.mode("append").parquet(path)
    with pytest.raises(Exception, match="`?a`?"):
        table_schemas(spark, {"t": path}).collect()
