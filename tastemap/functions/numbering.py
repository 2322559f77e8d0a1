"""Dense global row numbers without a single-task window.

``row_number() OVER (ORDER BY ...)`` without PARTITION BY moves every row into
one task, and a window partitioned by a hot key does the same for that key.
``rdd.zipWithIndex`` leaves Catalyst.  Here the rows are range-partitioned on
the full ordering (a hot key spreads over many partitions because the later
ordering columns split it), sorted inside each partition and tagged with
(partition, position).  The tagged rows are written once as a table below the
checkpoint folder: the tags become data, so the per-partition counts and the
numbering read the same values, a lost executor costs a re-read rather than a
recomputation that could draw other range bounds, and the lineage is cut.
The counts (one value per partition, so bounded by the partition count, not
by the data) become offsets, joined back as a broadcast table of that size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tastemap.sources.files import materialize

_POS_MASK = (1 << 33) - 1  # monotonically_increasing_id keeps the record number in the low 33 bits
ROWS_PER_PARTITION = 2_000_000  # rows one task sorts; keeps each range partition near 100 MB


def range_partitions(spark, expected_rows: int | None) -> int:
    """Partition count for a range sort.

    With a known row count: about ``ROWS_PER_PARTITION`` rows each, at least
    one partition per core.  Without one: the session's shuffle partitions.
    """
    if expected_rows is None:
        return int(spark.conf.get("spark.sql.shuffle.partitions"))
    cores = spark.sparkContext.defaultParallelism
    return max(cores, -(-int(expected_rows) // ROWS_PER_PARTITION))


def with_global_index(df: DataFrame, order_cols: list[str], name: str = "row_index",
                      num_partitions: int | None = None, expected_rows: int | None = None) -> DataFrame:
    """Add ``name``: 0-based position of each row in the total order ``order_cols``.

    Rows equal in every ordering column are interchangeable; list enough
    columns to make the order total where that matters.  ``expected_rows``
    (when known cheaply) sizes the range partitions.
    """
    spark = df.sparkSession
    n = num_partitions or range_partitions(spark, expected_rows)
    tagged = materialize(df.repartitionByRange(n, *order_cols)
                         .sortWithinPartitions(*order_cols)
                         .withColumn("_pid", F.spark_partition_id())
                         .withColumn("_pos", F.monotonically_increasing_id().bitwiseAND(F.lit(_POS_MASK))),
                         "numbered")

    counts = {r["_pid"]: r["_cnt"] for r in
              tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt")).collect()}
    offsets, acc = [], 0
    for pid in range(n):
        offsets.append((pid, acc))
        acc += counts.get(pid, 0)
    offset_table = spark.createDataFrame(offsets, "_pid INT, _offset LONG")
    return (tagged.join(F.broadcast(offset_table), "_pid")
            .withColumn(name, F.col("_offset") + F.col("_pos"))
            .drop("_pid", "_pos", "_offset"))


def with_running_sum(df: DataFrame, order_cols: list[str], weight: str, name: str,
                     num_partitions: int | None = None, expected_rows: int | None = None) -> DataFrame:
    """Add ``name``: the sum of ``weight`` over all rows before this one in the
    total order ``order_cols`` (an exclusive prefix sum), without a
    single-task window.

    Same scheme as ``with_global_index``: range partitions written once with
    their partition id, a running sum inside each partition (a window over one
    partition's rows), and per-partition totals as a broadcast offset table.
    """
    spark = df.sparkSession
    n = num_partitions or range_partitions(spark, expected_rows)
    tagged = materialize(df.repartitionByRange(n, *order_cols).withColumn("_pid", F.spark_partition_id()),
                         "running")
    before = Window.partitionBy("_pid").orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, -1)
    local = tagged.withColumn("_local", F.coalesce(F.sum(weight).over(before), F.lit(0)).cast("long"))
    totals = {r["_pid"]: r["_tot"] or 0 for r in
              tagged.groupBy("_pid").agg(F.sum(weight).alias("_tot")).collect()}
    offsets, acc = [], 0
    for pid in range(n):
        offsets.append((pid, acc))
        acc += int(totals.get(pid, 0))
    offset_table = spark.createDataFrame(offsets, "_pid INT, _offset LONG")
    return (local.join(F.broadcast(offset_table), "_pid")
            .withColumn(name, F.col("_offset") + F.col("_local"))
            .drop("_pid", "_local", "_offset"))
