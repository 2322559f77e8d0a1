"""The user–item interaction table derived from the driver's tables.

A customer (``o_custkey``) rates a part (``l_partkey``) once per line item;
the discount is mapped onto the 0, 0.5 .. 5.0 rating scale, zeros included
so that the ``rating != 0`` filter keeps its meaning.  ``ok`` and ``ln``
(order key, line number) are carried as row identity for stable ordering.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastemap.sources.tables import load_table

# The DuckDB / ANSI form of the same table, used by every oracle query.
INTERACTIONS_SQL = """SELECT o_custkey AS user_id, l_partkey AS item_id,
       round(l_discount * 100) / 2.0 AS rating,
       o_orderdate AS ts, l_orderkey AS ok, l_linenumber AS ln
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

INTERACTION_COLUMNS = ["user_id", "item_id", "rating", "ts", "ok", "ln"]


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem ⋈ orders on the order key, four lineitem and three orders columns read.

    Both inputs are fact tables that grow with the data, so the join is a
    sort-merge join on the order key (stated as a hint rather than left to a
    size estimate); AQE's skew handling splits a hot order.  The shuffle also
    spreads inputs stored in few large row groups over all cores.
    """
    li = load_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_partkey", "l_discount", "l_linenumber"])
    od = load_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    joined = li.join(od.hint("merge"), li.l_orderkey == od.o_orderkey)
    return joined.select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("item_id"),
        (F.round(F.col("l_discount") * 100) / 2.0).cast("double").alias("rating"),
        F.col("o_orderdate").alias("ts"),
        F.col("l_orderkey").alias("ok"),
        F.col("l_linenumber").alias("ln"),
    )
