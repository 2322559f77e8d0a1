"""A user holding a third of all rows: results stay exact and the work spreads."""

import duckdb
from pyspark.sql import functions as F

from conftest import SF_MID
from tastemap.operators.split import train_val_test
from tastemap.plans.oracle import SPLIT
from tastemap.sources.interactions import INTERACTIONS_SQL, interactions
from tastemap.sources.tables import table_path
from tools.oracle_check import digest

HOT_USER = 424242


def _skewed(df):
    return df.withColumn("user_id", F.when(F.col("ok") % 3 == 0, F.lit(HOT_USER)).otherwise(F.col("user_id")))


def _oracle():
    con = duckdb.connect()
    for t in ("lineitem", "orders"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF_MID, t)}')")
    skewed = (f"SELECT CASE WHEN ok % 3 = 0 THEN {HOT_USER} ELSE user_id END AS user_id, item_id, rating, ts, ok, ln "
              f"FROM ({INTERACTIONS_SQL})")
    sql = "WITH " + SPLIT.replace(f"inter AS ({INTERACTIONS_SQL})", f"inter AS ({skewed})", 1) + "\nSELECT * FROM split"
    return con.sql(sql).df()


def test_split_with_hot_user_matches_sql(spark):
    got = train_val_test(_skewed(interactions(spark, SF_MID))).toPandas()
    want = _oracle()
    assert (got.user_id == HOT_USER).mean() > 0.3
    assert digest(got) == digest(want)


def test_hot_user_spreads_over_range_partitions(spark):
    df = _skewed(interactions(spark, SF_MID))
    parts = (df.repartitionByRange(16, "user_id", "ts", "item_id", "ok", "ln", "rating")
             .filter(F.col("user_id") == HOT_USER).select(F.spark_partition_id().alias("p")).distinct().count())
    assert parts >= 4
