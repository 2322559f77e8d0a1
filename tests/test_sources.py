import pytest

from conftest import SF_SMALL
from tastemap.operators.prep import bernoulli_sample, drop_null_rows
from tastemap.session import scratch_path
from tastemap.sources.files import (read_parquet_table, repartition_layout, schema_report,
                                    write_single_csv, write_single_parquet)
from tastemap.sources.interactions import interactions
from tastemap.sources.tables import load_table


def test_schema_report(spark):
    rep = schema_report(interactions(spark, SF_SMALL)).orderBy("position").collect()
    assert [(r["column"], r["type"]) for r in rep] == [
        ("user_id", "bigint"), ("item_id", "bigint"), ("rating", "double"), ("ts", "timestamp_ntz"),
        ("ok", "bigint"), ("ln", "int")]


def test_single_file_sinks_refuse_large_inputs(spark):
    df = interactions(spark, SF_SMALL)
    path = scratch_path(spark, "one")
    write_single_parquet(df.limit(50), path)
    assert read_parquet_table(spark, path).count() == 50


def test_bernoulli_sample_and_layout(spark):
    df = interactions(spark, SF_SMALL)
    frac = bernoulli_sample(df, 0.25, 7).count() / df.count()
    assert 0.18 < frac < 0.32
    laid = repartition_layout(df, 5)
    assert laid.rdd.getNumPartitions() == 5 and laid.count() == df.count()
    by_key = repartition_layout(df, 3, ["user_id"])
    assert by_key.rdd.getNumPartitions() == 3


def test_unknown_table_and_null_drop(spark):
    with pytest.raises(ValueError):
        load_table(spark, SF_SMALL, "ratings")
    df = spark.createDataFrame([(1, None), (2, 3.0)], "user_id LONG, rating DOUBLE")
    assert drop_null_rows(df).count() == 1


def test_hash_sample_keeps_tiny_fractions(spark):
    from tastemap.operators.prep import hash_sample
    df = spark.range(200_000)
    assert 40 <= hash_sample(df, 0.0004, 7, ["id"]).count() <= 130
    assert 199_870 <= hash_sample(df, 0.9996, 7, ["id"]).count() <= 199_960
